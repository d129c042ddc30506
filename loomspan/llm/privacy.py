"""Personal information in free text: found by rules, replaced by placeholders and by keyed surrogates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Given names, female and male, and names of either kind.
FEMALE = """Anke Anna Annegret Aurélie Bea Begoña Belén Brigitte Camille Carmen Céline Charlotte Chloé Clara Dana Elena Élodie Emma Eva Friederike Greta
Hanna Harriet Heike Ingrid Isabel Jana Julia Käthe Laura Lena Leona Lucía Mareike Maria María Marisol Marta Mei Mireille Nadia Noémie Nuria Océane Olga Pilar
Priya Rocío Sabine Sarah Sofía Solène Sophie Ursula""".split()
MALE = """Álvaro Antonio Benoît Björn Callum Carlos David Diego Dieter Étienne Fabian Felix Gaël Gonzalo Grant Guillaume Hans Hugo Íñigo Jan Javier Joaquín Jonas
John Jörg José Jürgen Klaus Lothar Louis Luca Lucien Manuel Marco Markus Martin Michael Mohammed Moritz Noel Olivier Omar Owen Pablo Paul Peter Pierre Ramón Robert
Samuel Stefan Thibault Thomas Tobias Uwe Yusuf""".split()
# Particles of family names.
PARTICLES = ["de la", "de los", "de las", "del", "de", "von der", "von dem", "von", "van der", "van den", "van", "zu", "da", "di", "du", "des", "d'"]
# Capitalized words that begin sentences and are no names.
STARTERS = set(
    """A According Adresse Adverse After Allerdings Als Also An And As At Atentamente Auf Aucune Batch Because Befund Bei Both But By Cada Cependant Chaque Charge Columns
Comme Compte Consent Contact Contacto Cordialement Corresponding Das Dans De Der Des Die Documento Domicilio Dr Each Early Ein Eine El En Expression Fehlende For Frau From Further
He Her Hinweis Hubo His However Identity If Im In Informe It Its Jede Knock La Las Laut Le Les Lors Los Loss Manual Median Missing Mme Mr Mrs Ms My No Not Notably Nous On Or Our Para Particles Patient
Patientin Per Please Pour Qu Record Region Registered Reported Rückfragen Samples Se See Según She Signed Sin Since So Steuer Surprisingly Tel That The Their Then There These They This Those To
Monday Tuesday Wednesday Thursday Friday Saturday Sunday Montag Dienstag Mittwoch Donnerstag Freitag Samstag Sonntag
Yesterday Today Tomorrow Later Afterwards Meanwhile Finally Recently Gestern Heute Dann Später Hier Aujourd'hui Ensuite Puis Hoy Ayer Luego Después
Uptake Unerwünschte Une Un Una We Whether While Wir With Wohnhaft Write You Zusammenfassend Zwischen""".split()
)
# Words after a name that make it one: what people do.
AFTER_NAME = """noted|signed|tolerated|will return|reviewed|reported that|wrote|yesterday|belongs|called|said|says|asked|told|replied|lives|lived|works|worked|visited|phoned|telephoned|emailed|agreed|refused|consented|declined|complained
attended|arrived|thanked|thinks|believes|smokes|joined us|spoke|speaks|denies|explained|confirmed that|remembers|anmerkte|verträgt|kommt|sagte|sagt|schrieb|wohnt|arbeitet|fragte|bat|rief an|meinte|stimmte zu|berichtete|lehnte ab
va bien|reviendra|a noté|a signalé|a dit|a écrit|a demandé|a accepté|a refusé|habite|travaille|dit que|pense que|comentó|anotó|toleró|acudió|dijo|escribió|preguntó|vive en|vive|trabaja|aceptó|rechazó|llamó|refiere""".replace("\n", "|").split("|")

_PARTICLE_WORDS = {w for p in PARTICLES for w in p.split()}
_NO_FAMILY = STARTERS | {w.split()[0] for w in AFTER_NAME} | set("of at and was has is will und war hat wird kommt et y ha fue est".split())
_G = {g.casefold(): g for g in FEMALE + MALE}
_SEX = {g.casefold(): "f" for g in FEMALE} | {g.casefold(): "m" for g in MALE}


def _any_of(words: Iterable[str]) -> str:
    """A regular expression of one of the words, by their common beginnings; the longest that fits is tried first."""
    tree: dict = {}
    for word in words:
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def write(node: dict) -> str:
        parts = [regex.escape(c) + write(below) for c, below in sorted(node.items()) if c]
        if not parts:
            return ""
        return ("(?:" + "|".join(parts) + ")" + ("?" if "" in node else "")) if len(parts) > 1 or "" in node else parts[0]

    return "(?:" + write(tree) + ")"


_given = _any_of(FEMALE + MALE)
_given_upper, _given_lower = _any_of(g.upper() for g in FEMALE + MALE), _any_of(g.lower() for g in FEMALE + MALE)
#: The blanks between the words of a name.
BLANKS = " \u00a0\u2009\t"
_sp = rf"(?:[{BLANKS}]+)"
_cased = r"(?!(?:PhD|DPhil|PharmD|PsyD|EdD|MSc|BSc)\b)\p{Lu}(?=[\p{Lu}’']*\p{Ll})[\p{L}’']+"
_cap = rf"{_cased}(?:[-‐‑]{_cased})*"
_upp = r"\p{Lu}(?:[’']?\p{Lu})+(?:[-‐‑]\p{Lu}(?:[’']?\p{Lu})+)*"
_low = r"\p{Ll}(?:[’']?\p{Ll}){2,}(?:[-‐‑]\p{Ll}{2,})*"
_ini = r"\p{Lu}\.(?:[-‐‑]?\p{Lu}\.)*"
_part = "(?:" + "|".join(p.replace(" ", _sp) for p in PARTICLES) + ")"
_partu = _part.upper().replace("\\U00A0", "\\u00a0").replace("\\U2009", "\\u2009").replace("\\T", "\\t")
_NOT_LETTER = r"(?<![\p{L}\p{N}@])"
_END = r"(?![\p{L}\p{N}@]|[-‐‑]\p{L}|['’](?!s?\b)\p{L})"


def _forms(given: str, family: str, particle: str, initial: str = _ini) -> tuple[str, str]:
    """Regular expressions of given name first and of family name first."""
    fam = f"(?:{particle}{_sp})?{family}"
    return f"(?P<g>{given})(?:{_sp}{initial})*{_sp}(?P<f>{fam})(?:{_sp}(?P<f2>{fam}))?", f"(?P<f>{fam})(?:{_sp}(?P<f2>{family}))?,{_sp}(?P<g>{given})(?:{_sp}{initial})*"


# Titles and forms of address, which are no part of a name.
TITLES = """Mr Mrs Ms Mx Miss Dr Prof Dra Sr Sra Srta Hr Fr Herr Herrn Frau Fräulein Mme Mlle Madame Monsieur Mademoiselle Señor Señora Señorita Don Doña Professor Professorin Professeur Professeure Sir Dame
Lady""".split()
# What stands before a colon and a name.
LABELS = ["Contact", "Contacto", "Kontakt", "Ansprechpartner", "Ansprechpartnerin", "Corresponding author", "Author", "Investigator", "Attn", "Name", "Nombre", "Nom", "Betreuer", "Betreuerin"]
# What closes a letter before its writer's name.
CLOSINGS = ["Thanks", "Thank you", "Many thanks", "Best", "Cheers", "Danke", "Merci", "Gracias", "Hi", "Hello", "Hallo", "Bonjour", "Hola", "Signed", "Sincerely", "Regards", "Best wishes", "Kind regards", "Yours faithfully", "Atentamente", "Saludos", "Cordialement", "Bien à vous", "Mit freundlichen Grüßen", "Viele Grüße", "Beste Grüße"]
# Words that a person's name follows.
BEFORE_NAME = [
    "According to", "according to", "Laut", "laut", "D'après", "d'après", "D’après", "d’après", "Selon", "selon", "Según", "según", "Según anotó", "según anotó", "Según comentó", "según comentó", "Nach Angaben von",
    "nach Angaben von", "spoke with", "spoken to", "talked to", "belongs to", "returned by", "Reported by", "reported by", "Signed by", "signed by", "written by", "prepared by", "read by", "checked by", "reviewed by",
    "curated by", "scored by", "entered by", "data from", "message from", "call from", "copied to", "Dear", "Liebe", "Lieber", "Estimado", "Estimada", "Cher", "Chère", "données de", "datos de", "Daten von", "erstellt von",
    "unterschrieben von", "signé par", "signé par le", "signé par la", "firmado por", "firmado por el", "firmado por la", "comme l'a noté", "comme l’a noté", "Patient", "patient", "Patientin", "patientin",
    "Patiente", "patiente", "Patienten", "Paciente", "paciente", "Pacienta", "Teilnehmer", "Teilnehmerin", "Participant", "participant", "Participante", "participante",
]
# Words that a person's name often follows, but other names too.
WEAK_BEFORE = """met|meet|meeting|saw|asked|ask|told|tell|thank|thanked|thanks to|invited|visited|phoned|telephoned|emailed|contacted|informed|joined by|accompanied by|seen by|examined by|treated by|operated on by|referred by|signed for|on behalf of
traf|treffen mit|sprach mit|fragte|dankte|bat|gesehen von|untersucht von|behandelt von|begleitet von|rencontré|vu par|vue par|examiné par|examinée par|suivi par|suivie par|accompagné de|remercie|remercié
conocí a|vi a|preguntó a|visto por|vista por|atendido por|atendida por|acompañado de|acompañada de|agradezco a|de parte de""".replace("\n", "|").split("|")
# Words, in lower case, after names of methods, places and institutions.
NO_PERSON = set(
    """method methods score test index protocol assay scale criteria criterion staining stain trial study hospital institute university college clinic centre center ward department foundation laboratory lab road street lane avenue square
disease syndrome model algorithm classification system grade staging map award prize buffer medium cells cell line equation law effect sign procedure technique database registry cohort consortium society journal report
programme program project scheme panel fund service services team unit committee board council group office company
methode klinik krankenhaus institut universität skala verfahren färbung studie straße méthode échelle hôpital institut université essai étude rue método escala instituto universidad ensayo estudio calle hospital índice""".split()
)
_titles = _any_of(TITLES) + r"\.?"
_degree = rf"(?:{_sp}(?:med|rer|nat|phil|vet|Dr|habil|hc|h\.c|jur)\.)*"
_address_form = rf"{_NOT_LETTER}{_titles}{_degree}{_sp}"
_label = rf"{_any_of(LABELS)}[  ]?:\s*|{_any_of(CLOSINGS)},?\s+|{_any_of(BEFORE_NAME)}\s+"
_cue = regex.compile(rf"(?:{_NOT_LETTER}(?:{_label})|(?<=, )(?:as|wie)\s+)(?:{_titles}{_degree}{_sp})?|{_address_form}")
_titled = regex.compile(rf"(?:.*\s)?{_titles}{_degree}{_sp}", regex.DOTALL)

_joint_between = rf"{_sp}(?:and|und|y|e|et|&){_sp}"
_any_given = rf"(?:{_cap}|{_ini})"
_after_cue = [regex.compile(f"(?:{p}){_END}") for p in [*_forms(_any_given, _cap, _part), *_forms(rf"(?:{_upp}|{_ini})", _upp, _partu)]]
_lower_after_cue = [regex.compile(f"(?:{p}){_END}") for p in _forms(_given_lower, _low, _part, r"\p{Ll}\.")]
_spellings = [(_given, _cap, _part, _ini), (_given_upper, _upp, _partu, _ini)]
#: From a given name on: the name; and a family name and a comma before it, read backwards, with the given name's rest.
_given_first = [regex.compile(f"(?:{_forms(g, f, p, i)[0]}){_END}") for g, f, p, i in _spellings]
_family_first = [(regex.compile(rf"(?r){_NOT_LETTER}(?P<f>(?:{p}{_sp})?{f})(?:{_sp}(?P<f2>{f}))?,{_sp}"), regex.compile(f"(?P<g>{g})(?:{_sp}{i})*{_END}")) for g, f, p, i in _spellings]
#: A name that ends at a place, read backwards from there: with a given name, else with initials alone.
_ends_here = [regex.compile(rf"(?r){_NOT_LETTER}(?P<g>{given}){_sp}(?P<f>(?:{_part}{_sp})?{_cap}){second}") for given in (rf"{_cap}(?:{_sp}{_ini})*", rf"{_ini}(?:{_sp}{_ini})*") for second in (rf"{_sp}(?P<f2>{_cap})", "(?P<f2>)")]
_after_article = regex.compile(rf"(?r)(?<!\p{{L}})(?:the|an?|this|that|each|every|der|die|das|den|dem|des|ein|eine[mnrs]?|le|la|les|un|une|el|los|las|una){_sp}", regex.IGNORECASE)
_next_word = regex.compile(rf"{_sp}([\p{{L}}]+)")
_lower_before_word = regex.compile(rf"(?:{_forms(_given_lower, _low, _part, r'\p{Ll}\.')[0]})(?={_sp}(?:{'|'.join(AFTER_NAME)})\b|;[+(\d])")
_before_after_name = rf"(?={_sp}(?:{'|'.join(AFTER_NAME)})\b|;[+(\d])"
_learnt_first = [regex.compile(f"(?:{_forms(given, family, part, initial)[0]}){end}") for given, family, part, initial, end in ((_cap, _cap, _part, _ini, _END), (_upp, _upp, _partu, _ini, _END), (_low, _low, _part, r"\p{Ll}\.", _before_after_name))]
_learnt_after_cue = [regex.compile(f"(?:{p}){_END}") for p in _forms(_low, _low, _part, r"\p{Ll}\.")]
_family_before = regex.compile(rf"(?r){_NOT_LETTER}(?P<f>(?:{_part}{_sp})?{_cap}(?:{_sp}{_cap})?|(?:{_partu}{_sp})?{_upp}(?:{_sp}{_upp})?),{_sp}")
_rest_of_given = regex.compile(rf"\p{{L}}+(?:{_sp}{_ini})*{_END}")
_initials = regex.compile(_ini)
_before_joint = regex.compile(rf"(?r){_NOT_LETTER}({_ini}(?:{_sp}{_ini})*{_sp}(?:{_part}{_sp})?{_cap}){_joint_between}")
_semicolon = regex.compile(r";[+(\d]")
_initial_family = regex.compile(rf"{_ini}(?:{_sp}{_ini})*{_sp}(?:{_part}{_sp})?{_cap}{_END}")
_alone = regex.compile(rf"(?:{_part}{_sp})?(?:{_cap}|{_upp}){_END}")
_joint = regex.compile(_joint_between)
_second_ends = regex.compile(rf"[,.;()\n]|$|{_sp}\(|{_sp}(?:{'|'.join(AFTER_NAME)}|of|at|and|und|y|et|war|was|has|is|a été|acudió|ha)\b")

_at = r"(?:@|＠|﹫|[ \t]?[\[({][ \t]?(?:at|AT|arroba)[ \t]?[\])}][ \t]?|[ \t]+(?:AT|arroba)[ \t]+)"
_at_sign = regex.compile(_at)
_dot = r"(?:\.|[ \t]?[\[({][ \t]?(?:dot|DOT|punto|punkt|point)[ \t]?[\])}][ \t]?|[ \t]+(?:DOT|punto)[ \t]+)"
_labels = regex.compile(f"({_dot})")
_email = regex.compile(rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}_%+-]+(?:{_dot}[\p{{L}}\p{{N}}_%+-]+)*{_at}[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}-]*[\p{{L}}\p{{N}}])?(?:{_dot}[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}-]*[\p{{L}}\p{{N}}])?)*{_dot}\p{{L}}{{2,24}}(?![\p{{L}}\p{{N}}])")

_town = rf"{_cap}(?:[-‐‑](?:\p{{L}}+))*"
_towns = rf"\p{{Lu}}[\p{{L}}’'-]+(?:{_sp}\p{{Lu}}[\p{{L}}’'-]+){{0,2}}"
_break = r"(?:,[ \t]*\n?[ \t]*|[ \t]*\n[ \t]*)"
_us_tail = rf"(?:{_break}{_towns},?{_sp}(?:[A-Z]{{2}}{_sp}\d{{5}}(?:-\d{{4}})?|[A-Z]{{1,2}}\d[A-Z\d]?{_sp}\d[A-Z]{{2}})\b)?"
_eu_tail = rf"(?:{_break}(?:[A-Z]{{1,2}}-)?\d{{4,5}}{_sp}{_town})?"
_unit = rf"(?:{_break}(?:Apt|Apartment|Flat|Unit|Suite|Ste|Room|Floor|Bldg|#)\.?{_sp}?[\p{{L}}\d-]+)?"
_road = r"(?:Street|Road|Lane|Avenue|Court|Drive|Boulevard|Square|Terrace|Close|Crescent|Parkway|Highway|Way|Place|St|Ave|Ct|Ln|Blvd|Sq)\b|(?:Rd|Dr|Pl|Hwy)\b\.?"
_de_street = rf"(?:{_cap}{_sp})?(?:\p{{Lu}}[\p{{L}}-]*(?:straße|strasse|str\.|weg|gasse|allee|platz|ring|damm|ufer|steig|pfad)|(?:Straße|Strasse|Str\.|Weg|Gasse|Allee|Platz|Ring|Damm|Ufer))|(?:An|Am|Auf|Im|In|Zum|Zur|Unter|Hinter)(?:{_sp}(?:der|dem|den))?{_sp}{_cap}"
_ends = r"(?![\p{L}\p{N}])"
_addresses = [
    regex.compile(p)
    for p in (
        rf"{_NOT_LETTER}P\.?{_sp}?O\.?{_sp}Box{_sp}\d+{_us_tail}",
        rf"{_NOT_LETTER}(?:Postfach|Apartado(?:{_sp}de{_sp}[Cc]orreos)?|Apdo\.?|B\.?P\.?|Boîte{_sp}postale){_sp}\d[\d ]*{_break}(?:[A-Z]{{1,2}}-)?\d{{4,5}}{_sp}{_town}{_ends}",
        rf"(?<![\p{{L}}\p{{N}}.,/-])\d{{1,5}}[A-Za-z]?{_sp}(?:\p{{Lu}}[\p{{L}}’'.-]*{_sp}){{1,4}}?(?:{_road}){_unit}{_us_tail}{_ends}",
        rf"{_NOT_LETTER}(?:{_de_street}){_sp}\d{{1,4}}{_sp}?[a-z]?{_ends}(?:[-/]\d+)?{_eu_tail}{_ends}",
        rf"{_NOT_LETTER}(?:Calle|C/|C\.|Avda\.?|Avenida|Av\.|Paseo|P\.º|Plaza|Pza\.?|Pl\.|Camino|Ronda|Travesía|Carretera|Ctra\.|Glorieta){_sp}?(?:(?:de|del|la|las|los|el|y){_sp})*{_cap}(?:{_sp}(?:(?:de|del|la|las|los|el|y){_sp})*{_cap}){{0,3}},?{_sp}(?:n\.?[º°o]\.?{_sp}?|núm\.?{_sp}?)?\d{{1,4}}(?:{_sp}?(?:bis|[A-Z]))?{_ends}(?:,{_sp}\d{{1,2}}\.?[ºª°]{_sp}?(?:[A-Z]|izda|dcha|izq)?\.?{_ends})?{_eu_tail}{_ends}",
        rf"(?<![\p{{L}}\p{{N}}.,/-])\d{{1,4}}(?:{_sp}?(?:bis|ter|quater))?,?{_sp}(?:rue|avenue|av\.|bd|boulevard|place|chemin|impasse|allées?|quai|route|cours|square|passage|sentier|villa)(?:{_sp}(?:de|du|des|la|le|les|l['’]|d['’]))*{_sp}?(?:[ld]['’])?{_cap}(?:[-‐‑]\p{{L}}+)*(?:{_sp}{_cap})?{_eu_tail}{_ends}",
    )
]

_GERMAN, _FRENCH = 3, 5
_house_before = regex.compile(rf"(?r)\d(?:{_sp}?(?:bis|ter|quater))?,?{_sp}")
_before_number = r"(?<![\p{L}\p{N}_+])(?<![\d\p{L}][-.,:/–])"
_after_number = r"(?![\p{L}\p{N}_])(?![-.,:/–][\p{L}\p{N}])"
_ids = regex.compile(
    r"(?=[\dA-Z])" + _before_number
    + "(?:"
    + "|".join([
        r"MRN[- ]?\d{5,10}", r"[A-CEGHJ-PR-TW-Z]{2}[ -]?\d{2}[ -]?\d{2}[ -]?\d{2}[ -]?[A-D]", r"QQ[ -]?\d{2}[ -]?\d{2}[ -]?\d{2}[ -]?[A-D]", r"\d{3}([- ])\d{2}\1\d{4}", r"\d{3}([- ])\d{3}\2\d{4}",
        r"[A-Z]\d{3}-\d{4}", r"[A-Z]\d{2}[A-Z]\d{5}", r"[XYZ]-?\d{7}-?[A-Z]", r"\d{8}-?[A-Z]",
        r"[12]([ .]?)\d{2}\3\d{2}\3(?:\d{2}|2[AB])\3\d{3}\3\d{3}(?:\3\d{2})?", r"\d{2}([ ]?)\d{6}\4[A-Z]\4\d{3}", r"\d{2}([ ]?)\d{3}\5\d{3}\5\d{3}",
    ])
    + ")"
    + _after_number
)
_ext = r"(?:[ \t,]*(?:ext\.?|x|extension|extensión|ext|Durchwahl|DW|poste)[ \t]?\d{1,6})?"
_phones = regex.compile(
    r"(?=[\d+(])" + _before_number.replace("_+", "_")
    + "(?:"
    + "|".join([
        r"\+\d{1,3}[ .\-/]?(?:\(0?\d{0,4}\)[ ]?)?\d{1,12}(?:[ .\-/]\d{1,9}){0,6}", r"00[1-9]\d{0,2}[ .\-/](?:\(0?\d{0,4}\)[ ]?)?\d{1,12}(?:[ .\-/]\d{1,9}){0,6}",
        r"1[-. ]\d{3}([-. ])\d{3}\1\d{4}", r"(?:1[-. ])?\(\d{3}\)[ ]?\d{3}[-. ]\d{4}", r"\d{3}([-. ])\d{3}\2\d{4}",
        r"\(0\d{2,4}\)[ ]?\d{3,5}[ -]?\d{3,4}", r"0\d{2,4}[ /]\d{3,5}[ -]?\d{3,4}", r"0[1-9]([ .]?)\d{2}\3\d{2}\3\d{2}\3\d{2}", r"[6-9]\d{2}([ -]?)\d{3}\4\d{3}", r"[6-9]\d{2}([ ])\d{2}\5\d{2}\5\d{2}",
    ])
    + ")"
    + _ext
    + r"(?![\p{L}\p{N}_])(?![-.,:/–][\p{N}])"
)
_phone_cue = regex.compile(r"(?:[Pp]hone|[Mm]obile|[Cc]all|[Tt][ée]l|[Ff]ax|[Hh]andy|[Mm]óvil|[Ll]lame al|[Aa]ppelez le|unter|[Rr]ing|[Pp]ager|portable)\b[^\p{L}\d]{0,6}(?:at |on |to )?$|;$")
_id_cue = regex.compile(r"(?:SSN|Record|Identity no|ID|Nr|N[o°º]|n[°º]|DNI|NIE|MRN|NHS|Documento|nummer|sociale?|[Pp]assport|[Pp]asaporte|Reisepass|[Nn]úm|number|no)\b[^\p{L}\d]{0,5}$")
#: Where a sentence, or another number, begins; read backwards from a number.
_begins = regex.compile(r"(?r)\d{3}|\n|[.!?;][ \t\n\u00a0\u2009]+\p{Lu}")
_wide_cue = regex.compile(
    r"(?<![\p{L}\p{N}])(?:(?P<phone>[Pp]honed?|[Tt]elephoned?|[Tt]elefon\w*|[Tt]él[ée]phon\w*|[Tt]eléfono|[Mm]obile|[Cc]ell|[Cc]all(?:ed|s|ing)?|[Tt][ée]l|[Ff]ax|[Hh]andy|[Mm]óvil|[Ll]lame|[Aa]ppelez|[Rr]ing|[Rr]each(?:ed|able)?|[Dd]ial|[Tt]ext|[Pp]ager|[Vv]oicemail|portable)"
    r"|SSN|ID|DNI|NIE|MRN|NHS|[Rr]ecords?|[Pp]atient (?:no|number)|[Ii]dentity|[Ii]dentification|[Dd]ocumento|[Nn]ational insurance|[Ii]nsurance|[Vv]ersicher\w*|[Pp]assport|[Pp]asaporte|Reisepass|[Ss]ocial security|[Ss]écurité sociale)(?![\p{L}\p{N}])"
)
_nanp = regex.compile(r"(?![2-9]11)[2-9][0-8]\d(?!\d11)[2-9]\d{6}")
_other_cue = regex.compile(r"(?:catalogue no|catalog no|[Ll]ot|[Rr]atio|Messwert|Bestell-Nr|COSMIC id|chr\w*|doi|code|Grant|Pedido|Référence|colis|caja|seed|build|version|pages?|accession|Charge|Katalog-Nr|Ref)\b[.:]?[ \t]?$")


_long_number = regex.compile(r"\d[\d ./()-]{4}")
_threes, _no_number, _digit = regex.compile(r"\d{3}[- ]\d{3}[- ]\d{4}"), regex.compile(r"[^\d\s()+./-]"), regex.compile(r"\d")
_de_place = regex.compile(r"\p{L}+[   \t]+(?:(?:der|dem|den)[   \t]+)?\p{Lu}[\p{L}’'‐‑-]+[   \t]+\d")


@dataclass(frozen=True)
class Entity:
    kind: str
    start: int
    end: int


def _digits(text: str) -> int:
    return sum(c.isdigit() for c in text)


class _Found:
    def __init__(self) -> None:
        self.spans: list[Entity] = []

    def free(self, start: int, end: int) -> bool:
        return all(end <= s.start or start >= s.end for s in self.spans)

    def add(self, kind: str, start: int, end: int) -> bool:
        if start < end and self.free(start, end):
            self.spans.append(Entity(kind, start, end))
            return True
        return False


def find_entities(text: str, learnt: frozenset[str] = frozenset()) -> list[Entity]:
    """The personal information in a text, in order: kind and code point positions. learnt are further given names, case-folded.

    Kinds are taken in the order email, address, id_number and phone, person; none overlaps an earlier one.
    """
    found, places, done = _Found(), _places(text, learnt), 0
    for sign in _at_sign.finditer(text) if places.emails else ():  # an address lies within a line
        if sign.start() >= done:
            line, done = text.rfind("\n", 0, sign.start()) + 1, text.find("\n", sign.end()) % (len(text) + 1)
            for m in _email.finditer(text, line, done):
                found.add("email", m.start(), m.end())
    if _digit.search(text):
        for form in sorted(places.forms):
            for m in _addresses[form].finditer(text):
                found.add("address", m.start(), m.end())
        _numbers(text, found)
    _persons(text, places, found, learnt)
    return sorted(found.spans, key=lambda e: e.start)


#: What stands right before a number is looked for in so many characters; every such cue, with what may follow it, is shorter.
CUE_LENGTH = 32


def _numbers(text: str, found: _Found) -> None:
    if not _long_number.search(text):  # every id number and phone has such a run
        return
    ids = {m.span(): m for m in _ids.finditer(text)}
    phones = {m.span(): m for m in _phones.finditer(text)}
    for start, end in sorted({*ids, *phones}, key=lambda s: (s[0] - s[1], s[0])):
        before, word = text[max(0, start - CUE_LENGTH) : start], text[start:end]
        if _other_cue.search(before):
            continue
        phone, number = (start, end) in phones, (start, end) in ids
        if phone and number:
            phone = _is_phone(text, start, end)
        if phone and not 9 <= _digits(_no_number.split(word)[0]) <= 15:
            continue
        found.add("phone" if phone else "id_number", start, end)


def _is_phone(text: str, start: int, end: int) -> bool:
    """Whether a number that has the form of a phone and of an id number is a phone.

    A phone's cue right before it decides; else the last word of the sentence so far that tells a kind; else the structure:
    a North American area and exchange make a phone, unless an id's cue stands before or it is a valid NHS number as these
    are written, with blanks.
    """
    before, word = text[max(0, start - CUE_LENGTH) : start], text[start:end]
    if _phone_cue.search(before):
        return True
    if not _threes.fullmatch(word):
        return False
    said = 0
    begun = _begins.search(text, 0, start)
    for m in _wide_cue.finditer(text, begun.start() + 1 if begun else 0, start):
        said = 1 if m.group("phone") else -1
    digits = regex.sub(r"\D", "", word)
    if _id_cue.search(before) or not _nanp.fullmatch(digits) or " " in word and _nhs_number(digits):
        return said > 0
    return said >= 0


def _nhs_number(digits: str) -> bool:
    """Whether the last of ten digits is the check digit of the others (modulo 11)."""
    return (11 - sum((10 - i) * int(d) for i, d in enumerate(digits[:9])) % 11) % 11 == int(digits[9])


def _clip(text: str, m: regex.Match) -> tuple[int, int] | None:
    """The span of a name, without a second family name that begins the next sentence; None if it is no name."""
    given, family = m.group("g"), m.group("f")
    if any(w in STARTERS for w in (given, family.split()[-1])) or given in STARTERS:
        return None
    end = m.end()
    if m.group("f2"):
        if m.start("g") < m.start("f"):
            if m.group("f2").split()[-1] in _NO_FAMILY or not _second_ends.match(text, m.end()):
                end = m.end("f")
        elif m.group("f") in STARTERS:
            return m.start("f2"), end
    return m.start(), end


@lru_cache(maxsize=2)
def _triggers(learnt: frozenset[str]):
    """An automaton of (what, length): 0 what can begin a cue, 1 given names in three spellings, 2 endings of German streets,
    3 words that begin other German addresses, 4 words that follow names, 5 learnt given names, 6 what can begin a weak cue, 7 what stands in an email, 8 what stands in other addresses (length and form)."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    blank = " \t\n\r\u00a0\u2009\u202f"
    for words, ends in ((LABELS, blank + ":"), (CLOSINGS, blank + ","), (BEFORE_NAME, blank), (TITLES, blank + ".")):
        for word in words:
            for end in ends:
                automaton.add_word(word + end, (0, len(word)))
    for word in ("as", "wie"):
        for end in blank:
            automaton.add_word(f", {word}{end}", (0, len(word)))
    for word in WEAK_BEFORE:
        for end in BLANKS:
            if not automaton.exists(word + end):
                automaton.add_word(word + end, (6, len(word)))
    for name in FEMALE + MALE:
        for spelled in (name, name.upper(), name.lower()):
            automaton.add_word(spelled, (1, len(spelled)))
    for name in learnt - _G.keys():
        for spelled in (name, name.upper(), name.title()):
            automaton.add_word(spelled, (5, len(spelled)))
    for word in ("straße", "strasse", "str.", "Str.", "weg", "Weg", "gasse", "Gasse", "allee", "Allee", "platz", "Platz", "ring", "Ring", "damm", "Damm", "ufer", "Ufer", "steig", "pfad", "Straße", "Strasse"):
        for end in blank:
            automaton.add_word(word + end, (2, 0))
    for word in ("An", "Am", "Auf", "Im", "In", "Zum", "Zur", "Unter", "Hinter"):
        for end in blank:
            automaton.add_word(word + end, (3, len(word)))
    for sign in _AT_WORDS:
        automaton.add_word(sign, (7, len(sign)))
    for form, words in enumerate(_ADDRESS_WORDS):
        for word in words:
            if not automaton.exists(word):
                automaton.add_word(word, (8, (len(word), form)))
    for word in AFTER_NAME:
        for before in BLANKS:
            automaton.add_word(before + word, (4, len(word)))
    automaton.make_automaton()
    return automaton


# What addresses of each form can't be without, in the order of _addresses; German ones are told by place.
_ADDRESS_WORDS = [
    ["Box"], ["Postfach", "Apartado", "Apdo", "BP", "B.P", "BP", "Boîte"],
    "Street Road Lane Avenue Court Drive Boulevard Square Terrace Close Crescent Parkway Highway Way Place St Ave Ct Ln Blvd Sq Rd Dr Pl Hwy".split(), [],
    "Calle C/ C. Avda Avenida Av. Paseo P.º Plaza Pza Pl. Camino Ronda Travesía Carretera Ctra Glorieta".split(),
    "rue avenue av. bd boulevard place chemin impasse allée allées quai route cours square passage sentier villa".split(),
]
# What an email address can't be without, as it is written.
_AT_WORDS = ["@", "＠", "﹫", "arroba", *[b + x + w for b in "[({" for x in ("", " ", "\t") for w in ("at", "AT")], *[x + "AT" + y for x in " \t" for y in " \t"]]


@dataclass
class _Places:
    """Where cues may begin, where listed given names begin, where names may end by what follows, where learnt
    given names begin, where names may begin after weak cues, and whether German addresses can be there at all."""

    cues: list[int]
    given: list[int]
    after: list[int]
    learnt: list[int]
    weak: list[int]
    forms: set[int]
    emails: bool


def _places(text: str, names: frozenset[str] = frozenset()) -> _Places:
    cues, given, learnt, weak, german = set(), [], [], [], False
    after = [m.start() for m in _semicolon.finditer(text)] if ";" in text else []
    forms, emails = set(), False
    for end, (what, length) in _triggers(names).iter(text):
        if what == 0:
            cues.add(end - length)
        elif what == 1:
            start = end + 1 - length
            if (start == 0 or not (text[start - 1].isalnum() or text[start - 1] == "@")) and (end + 1 == len(text) or not text[end + 1].isalnum()):
                given.append(start)
        elif what == 4:
            if end + 1 == len(text) or not (text[end + 1].isalnum() or text[end + 1] == "_"):
                after.append(end - length)
        elif what == 6:
            start = end - length
            if text[end + 1 : end + 2].isupper() and (start == 0 or not text[start - 1].isalnum()):
                weak.append(end + 1)
        elif what == 7:
            emails = True
        elif what == 8:
            word, form = length
            if form not in forms and end + 1 < len(text) and not text[end + 1].isalpha():
                if form != _FRENCH:
                    forms.add(form)
                elif _house_before.match(text, 0, end + 1 - word):
                    forms.add(form)
        elif what == 5:
            start = end + 1 - length
            if (start == 0 or not (text[start - 1].isalnum() or text[start - 1] == "@")) and (end + 1 == len(text) or not text[end + 1].isalnum()):
                learnt.append(start)
        elif not german:
            german = text[end + 1 : end + 4].lstrip()[:1].isdigit() if what == 2 else _de_place.match(text, end - length) is not None
    if german:
        forms.add(_GERMAN)
    return _Places(sorted(cues), sorted(set(given)), after, learnt, weak, forms, emails)


def _cued(text: str, places: _Places, found: _Found, learnt: frozenset[str] = frozenset()) -> Iterator[tuple[tuple[int, int], str, str, bool]]:
    """(span, given name or empty, family name, whether after a title) of the persons after cues, each added to found."""
    last = 0
    for place in places.cues:
        if place < last or not (m := _cue.match(text, place)):
            continue
        at = last = m.end()
        titled = _titled.fullmatch(m.group()) is not None
        best, given, family = None, "", ""
        for pattern in (*_after_cue, *_lower_after_cue):
            if (hit := pattern.match(text, at)) and (span := _clip(text, hit)) and found.free(*span):
                known = (fold := hit.group("g").casefold()) in _G or fold in learnt or _initials.fullmatch(hit.group("g"))
                first = hit.start("f") < hit.start("g")
                if first and not known:
                    continue
                if best is None or (span[1] - span[0]) > (best[1] - best[0]) and first:
                    best, given, family = span, hit.group("g"), hit.group("f")
        for pattern in _learnt_after_cue if best is None and learnt else ():
            if (hit := pattern.match(text, at)) and hit.group("g") in learnt and (span := _clip(text, hit)) and found.free(*span):
                best, given, family = span, hit.group("g"), hit.group("f")
                break
        if best is None and titled and (hit := _alone.match(text, at)) and hit.group().split()[-1] not in STARTERS:
            best = hit.span()
        if best is not None and found.add("person", *best):
            yield best, given, family, titled


def _persons(text: str, places: _Places, found: _Found, learnt: frozenset[str] = frozenset()) -> None:
    for span, _, _, _ in _cued(text, places, found, learnt):
        _joined(text, span[1], found)
    for first, (before, rest) in zip(_given_first, _family_first, strict=True):
        _take(text, first, places.given, found)
        for start in places.given:
            if (g := rest.match(text, start)) and (f := before.match(text, 0, start)) and g.group("g") not in STARTERS:
                starter = f.group("f") in STARTERS
                if f.group("f2") and starter:
                    found.add("person", f.start("f2"), g.end())
                elif f.group("f").split()[-1] not in STARTERS:
                    found.add("person", f.start("f"), g.end())
    for end in places.after:
        _ending_at(text, end, found)
    if places.after:
        _take(text, _lower_before_word, places.given, found)
    for start in places.weak:
        if (m := _after_cue[0].match(text, start)) and (span := _clip(text, m)) and _personal(text, m, span[1]) and found.add("person", *span):
            _joined(text, span[1], found)
    for start in places.learnt:
        _learnt_at(text, start, learnt, found)
    for e in list(found.spans):  # M. Holt and Priya Quill: what stands before the joint
        if e.kind == "person":
            if (m := _before_joint.match(text, 0, e.start)) is not None:
                found.add("person", m.start(1), m.end(1))


def _learnt_at(text: str, start: int, learnt: frozenset[str], found: _Found) -> None:
    """The person with the learnt given name that begins here."""
    for pattern in _learnt_first:
        if (m := pattern.match(text, start)) and regex.split("[-‐‑]", m.group("g"))[0].casefold() in learnt and m.group("f").split()[-1] not in _NO_FAMILY:
            if (span := _clip(text, m)) and found.add("person", *span):
                _joined(text, span[1], found)
            return
    if (rest := _rest_of_given.match(text, start)) and not text[start].islower() and (m := _family_before.match(text, 0, start)) and not set(m.group("f").split()) & STARTERS:
        found.add("person", m.start("f"), rest.end())


def _take(text: str, pattern: regex.Pattern, starts: list[int], found: _Found) -> None:
    """The persons whose names begin at these places."""
    for start in starts:
        if (m := pattern.match(text, start)) and (span := _clip(text, m)) and found.add("person", *span):
            _joined(text, span[1], found)


def _ending_at(text: str, end: int, found: _Found) -> None:
    """The person whose name ends here, before the blanks in front of ``end``."""
    while end > 0 and text[end - 1] in BLANKS:
        end -= 1
    for pattern in _ends_here:
        if (m := pattern.match(text, 0, end)) and not {m.group("g").split()[0], *m.group("f").split()} & STARTERS:
            sure = _initials.match(m.group("g")) is not None or text[end : end + 1] == ";"  # a record's name before its number
            if (sure or not _after_article.match(text, 0, m.start()) and _personal(text, m, end)) and found.add("person", m.start(), end):
                _joined(text, end, found)
            return


def _personal(text: str, m: regex.Match, end: int) -> bool:
    """Whether a name by shape alone can be a person's: no further name and no method, place or institution follows it, and
    the text has none of its words in lower case."""
    after = _next_word.match(text, end)
    words = [w for w in regex.split(r"[^\p{L}]+", m.group()) if len(w) > 1]
    if after and (after.group(1)[0].isupper() or after.group(1).lower() in NO_PERSON) or any(w.lower() in NO_PERSON for w in words):
        return False
    return not any(regex.search(rf"(?<!\p{{L}}){w.lower()}(?!\p{{L}})", text) for w in words if w.lower() in text and w.lower() not in _PARTICLE_WORDS)


def _joined(text: str, at: int, found: _Found) -> None:
    if joint := _joint.match(text, at):
        for pattern in (_initial_family, *_lower_after_cue):
            if m := pattern.match(text, joint.end()):
                found.add("person", m.start(), m.end())
        m = _after_cue[0].match(text, joint.end())
        if m and m.start("g") < m.start("f") and (span := _clip(text, m)) and _personal(text, m, span[1]):
            found.add("person", *span)


# Surrogates

def _range(first: int, last: int) -> str:
    return "".join(c for c in map(chr, range(first, last + 1)) if c.isalpha() and c.islower())


# Of each script the consonants and vowels of invented syllables, a consonant in none of them, and the letters that names are counted by.
_SCRIPTS = {
    "Latin": ("bdfgklmnprstv", "aeiou", "z", "abcdefghijklmnopqrstuvwxyz" + _range(0xDF, 0x17E)),
    "Cyrillic": ("бдфгклмнпрств", "аеиоу", "з", _range(0x430, 0x45F)),
    "Greek": ("βδφγκλμνπρστθ", "αειου", "ζ", _range(0x3AC, 0x3CE)),
    "Armenian": ("բդֆգկլմնպրստվ", "աեիոօ", "զ", _range(0x561, 0x586)),
}
_script_of = regex.compile("|".join(rf"(?P<{name}>\p{{Script={name}}})" for name in _SCRIPTS))
_letters, _digit_runs, _capitalized, _road_word = regex.compile(r"\p{L}+"), regex.compile(r"\d+"), regex.compile(r"\p{Lu}[\p{L}’']{2,}"), regex.compile(_road)
_ASCII = "abcdefghijklmnopqrstuvwxyz"


def _count(word: str, letters: str) -> int:
    """A number that no other word has; characters that are not among the letters are spelled out."""
    base, n = len(letters) + 1, 0
    for c in word:
        at = letters.find(c)
        for d in (at,) if at >= 0 else (base - 1, *(ord(c) // len(letters) ** i % len(letters) for i in range(5))):
            n = n * base + d + 1
    return n


@lru_cache(maxsize=10_000)
def _kind_of(c: str) -> str:
    """The digits or letters that a sign is one of: of its script and case; a sign of no kind is its own."""
    if c.isdecimal():
        zero = ord(c) - int(c)
        return "".join(map(chr, range(zero, zero + 10)))
    script = (m := _script_of.match(c)) and m.lastgroup
    letters = _ASCII if c.isascii() else "".join(x for x in _SCRIPTS[script][3] if not x.isascii() and len(x.upper()) == 1 and x.upper().lower() == x) if script else ""
    return next((k for k in (letters, letters.upper()) if c in k), c)


class Surrogates:
    """Keyed replacements that keep kind, sex, script, case and format; one value has one surrogate, two have two, in all texts.

    The key decides every replacement, and every replacement is a keyed permutation: of the given names of a sex, of the
    letters an initial may be, of all numbers of a format, and of all words, which are counted and written in syllables of
    their script (at most as many words as syllables of a length can tell apart). So no state is kept, and a name's parts,
    replaced one by one, refer to the same person everywhere. Words of other scripts than the four listed turn Latin.
    """

    def __init__(self, key: bytes) -> None:
        self.key = blake2b(key, digest_size=64).digest()
        self.word, self.signs, self._begun = lru_cache(maxsize=100_000)(self._word), lru_cache(maxsize=100_000)(self._signs), lru_cache(maxsize=10_000)(self._begin)

    def _begin(self, what: str, n: int):
        """A keyed hash, begun with a permutation's name and size."""
        return blake2b(f"{what}\0{n}\0".encode("utf-8", "surrogatepass"), digest_size=64, key=self.key)

    def _permuted(self, what: str, x: int, n: int, back: bool = False) -> int:
        """Another of the numbers below n for each of them: a Feistel network, walked until it stays below n."""
        high = isqrt(n - 1) + 1
        low = -(-n // high)
        begun = self._begun(what, n)
        while True:
            left, right = divmod(x, low)
            for turn in range(7, -1, -1) if back else range(8):
                mixed = begun.copy()
                mixed.update(b"%d\0%d" % (turn, left if turn % 2 else right))
                drawn = int.from_bytes(mixed.digest(), "big")
                drawn = -drawn if back else drawn
                left, right = (left, (right + drawn) % low) if turn % 2 else ((left + drawn) % high, right)
            x = left * low + right
            if x < n:
                return x

    def _moved(self, what: str, x: int, n: int) -> int:
        """As _permuted, but no number stays as it is, unless it is the only one."""
        return self._permuted(what, (self._permuted(what, x, n) + 1) % n, n, back=True)

    @staticmethod
    def _like(model: str, word: str) -> str:
        return word.upper() if len(model) > 1 and model.isupper() else word.lower() if model.islower() else word[:1].upper() + word[1:].lower()

    def _word(self, model: str) -> str:
        """A name's part: a given name becomes one of its sex, an initial another letter, anything else invented syllables."""
        fold = model.casefold()
        if len(model) == 1:
            return self.signs(model)
        if fold in _SEX:
            pool = FEMALE if _SEX[fold] == "f" else MALE
            return self._like(model, pool[self._moved(_SEX[fold], pool.index(_G[fold]), len(pool))])
        script = (m := _script_of.search(fold)) and m.lastgroup or "Latin"
        consonants, vowels, further, letters = _SCRIPTS[script]
        plain = all(c in _ASCII for c in fold)
        number = 2 * _count(fold, _ASCII) if plain else 2 * _count(fold, letters) + 1
        length, base = 3, len(consonants) * len(vowels)
        while number >= base**length:
            length += 1
        drawn, made = self._permuted(f"word {script}", number, base**length), ""
        for _ in range(length):
            drawn, c = divmod(drawn, base)
            made += consonants[c // len(vowels)] + vowels[c % len(vowels)]
        if made == fold or made in _SEX:  # longer, by a syllable that no other has
            made += further + vowels[0]
        return self._like(model, made)

    def _signs(self, model: str) -> str:
        """A number or code: its digits and letters become others of their kinds, at least one of them another; all else is kept."""
        kinds = list(map(_kind_of, model))
        number, total = 0, 1
        for c, kind in zip(model, kinds, strict=True):
            number, total = number * len(kind) + kind.index(c), total * len(kind)
        if total == 1:
            return model
        number, made = self._moved("signs " + "|".join(k[0] for k in kinds), number, total), []
        for kind in reversed(kinds):
            number, d = divmod(number, len(kind))
            made.append(kind[d])
        return "".join(reversed(made))

    def of(self, kind: str, text: str) -> str:
        if kind == "person":
                        return _letters.sub(lambda m: m.group() if m.group().lower() in _PARTICLE_WORDS else self.word(m.group()), text)
        if kind == "email":
            at = _at_sign.search(text)
            *labels, top = _labels.split(text[at.end() :])
            domain = "".join(x if i % 2 else self._parts(x) for i, x in enumerate(labels)) + top  # every second is a dot
            return "".join(x if i % 2 else self._parts(x) for i, x in enumerate(_labels.split(text[: at.start()]))) + at.group() + domain
        if kind == "address":
            return _capitalized.sub(lambda m: m.group() if _road_word.fullmatch(m.group()) or m.group() in STARTERS else self.word(m.group()), self.signs_in(text))
        return self.signs(text)

    def _parts(self, text: str) -> str:
        return _letters.sub(lambda m: self.word(m.group()), self.signs_in(text))

    def signs_in(self, text: str) -> str:
        return _digit_runs.sub(lambda m: self.signs(m.group()), text)


#: A given name is learnt from so many mentions after titles, or from so many different family names after any cue.
LEARN_TITLED, LEARN_FAMILIES = 2, 3
#: More learnt names than this are refused, as every task holds them.
MOST_LEARNT = 200_000


def _cued_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            if text:
                for _, given, family, titled in _cued(text, _places(text), _Found()):
                    fold = given.casefold()
                    if fold.isalpha() and len(fold) > 1 and fold not in _G:
                        rows.append({"given": fold, "family": family.casefold(), "titled": int(titled)})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("given", pa.string()), ("family", pa.string()), ("titled", pa.int64())]))


def learnt_names(documents: DataFrame, text: str = "text") -> frozenset[str]:
    """Given names that are not listed but stand after titles or other cues of the texts, case-folded.

    Reads the texts once, at once. A word counts as a name if it stands after titles LEARN_TITLED times or has, after any
    cue, LEARN_FAMILIES different family names; texts are counted as often as they occur.
    """
    cued = documents.select(documents[text].cast("string").alias("text")).mapInArrow(_cued_batches, "given string, family string, titled bigint")
    names = cued.groupBy("given", "family").agg(F.sum("titled").alias("titled")).groupBy("given").agg(F.sum("titled").alias("titled"), F.count("*").alias("families"))
    names = names.filter((F.col("titled") >= LEARN_TITLED) | (F.col("families") >= LEARN_FAMILIES)).select("given").limit(MOST_LEARNT + 1).collect()
    if len(names) > MOST_LEARNT:
        raise ValueError(f"more than {MOST_LEARNT} given names learnt")
    return frozenset(r[0] for r in names)


def _find_batches(key: bytes, learnt: frozenset[str] = frozenset()):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("char_start", pa.int64()), ("char_end", pa.int64()), ("surrogate", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                rows.append([{"kind": e.kind, "char_start": e.start, "char_end": e.end, "surrogate": surrogates.of(e.kind, text[e.start : e.end])} for e in find_entities(text, learnt)] if text else [])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(rows, kind)], names=["key", "text", "entities"])

    return run


def personal_information(documents: DataFrame, key: str = "doc_id", text: str = "text", *, secret: bytes) -> DataFrame:
    """(key, text, entities): every text with the persons, emails, phones, id numbers and addresses in it.

    entities is an array of (kind, char_start, char_end, surrogate) in order, without overlaps; positions count Unicode code
    points from 0, the end is exclusive. Null and empty texts have none. One row per row, repeated rows and null keys
    included; other columns are ignored; texts are read whole. Surrogates depend on ``secret`` and the value alone; who has
    the secret can tell whose surrogate it is, so there is no default. The texts are read twice, the first time at once, for
    the given names that stand after cues anywhere in them (learnt_names); only those names are shuffled.
    """
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(documents[key].alias("key"), documents[text].cast("string").alias("text"))
    found = rows.mapInArrow(_find_batches(secret, learnt_names(rows)), f"key {kind}, text string, entities array<struct<kind:string,char_start:bigint,char_end:bigint,surrogate:string>>")
    return found.withColumnRenamed("key", key)


def occurrences(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, kind, char_start, char_end): one row per occurrence."""
    return found.select(key, F.inline("entities")).select(key, "kind", "char_start", "char_end")


def replaced(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, redacted, surrogate_text): the texts with a placeholder ([PERSON], [EMAIL], ...) or a surrogate at each occurrence."""

    def with_(insert) -> F.Column:
        start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
        done = F.aggregate("entities", start, lambda acc, e: F.struct(F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, e["char_start"] - acc["at"]), insert(e)).alias("out"), e["char_end"].alias("at")))
        return F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.length("text")))

    return found.select(key, with_(lambda e: F.concat(F.lit("["), F.upper(e["kind"]), F.lit("]"))).alias("redacted"), with_(lambda e: e["surrogate"]).alias("surrogate_text"))
