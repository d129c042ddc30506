"""Freely typed values to the entries of a reference list: automaton first, token-set similarity for the rest."""

from __future__ import annotations

import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: A reference list larger than this is refused: it is broadcast, and each worker keeps about 4 KB of it an entry.
MAX_ENTRIES = 100_000
#: Token-set similarity from which a value counts as an entry.
LEAST_SIMILARITY = 0.70
#: A worker keeps the answers to so many distinct values, and the neighbours of so many distinct words.
CACHE_VALUES = 500_000

# Chemical symbols and formulas in the names of salts, in lower case.
SALTS = {"na": "sodium", "k": "potassium", "ca": "calcium", "mg": "magnesium", "hcl": "hydrochloride", "hbr": "hydrobromide"}
# Signs that scanning confuses.
SCANNED_AS = {"0": "o", "1": "l", "5": "s", "8": "b"}
# Words that say nothing about an entry.
FILLER = {"the", "of", "a", "an", "and"}
# What British spelling has for American letters.
SPELLINGS = [("our", "or"), ("ae", "e"), ("oe", "e"), ("ll", "l"), ("ise", "ize"), ("isation", "ization"), ("yse", "yze")]

_WORDS = regex.compile(r"[\p{L}\p{N}]+\.?")


def _plain(text: str) -> str:
    if text.isascii():
        return text.lower()
    marks_off = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return marks_off.casefold()


def _tokens(text: str) -> tuple[list[str], list[bool]]:
    """The words of a value and whether each ends with a full stop, as abbreviations do."""
    found = _WORDS.findall(_plain(text).replace("_", " "))
    return [w.rstrip(".") for w in found], [w.endswith(".") for w in found]


def _unscan(word: str) -> str:
    """A word with digits among its letters, those digits read as letters."""
    if any(c.isdigit() for c in word) and sum(c.isalpha() for c in word) > sum(c.isdigit() for c in word) and len(word) > 5:
        return "".join(SCANNED_AS.get(c, c) for c in word)
    return word


def edit_distance(a: str, b: str, most: int) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours from a to b; most + 1 if more than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    begin, end_a, end_b = 0, len(a), len(b)
    while begin < min(end_a, end_b) and a[begin] == b[begin]:
        begin += 1
    while min(end_a, end_b) > begin and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    a, b = a[begin:end_a], b[begin:end_b]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def _left_over(words: list[str], depth: int) -> np.ndarray:
    """For words of one length, a row each: hashes of all that up to ``depth`` deletions leave of them."""
    n = len(words[0])
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n).astype(np.uint64) + np.uint64(1)
    base = np.uint64(0x9E3779B97F4A7C15)
    power = np.ones(n + 1, np.uint64)
    power[1:] = np.cumprod(np.full(n, base))
    begun = np.zeros((len(words), n + 1), np.uint64)  # the hash of each beginning
    for i in range(n):
        begun[:, i + 1] = begun[:, i] * base + codes[:, i]
    whole = begun[:, n:]
    out = [whole]
    if depth > 0 and n > 0:
        i = np.arange(n)
        out.append(begun[:, i] * power[n - 1 - i] + whole - begun[:, i + 1] * power[n - 1 - i])
    if depth > 1 and n > 1:
        i, j = np.triu_indices(n, 1)
        out.append(begun[:, i] * power[n - 2 - i] + (begun[:, j] - begun[:, i + 1] * power[j - i - 1]) * power[n - 1 - j] + whole - begun[:, j + 1] * power[n - 1 - j])
    return np.concatenate(out, axis=1)


def _allowed(word: str) -> int:
    return 0 if len(word) < 4 else 1 if len(word) < 6 else 2


def _spelled(word: str) -> str:
    """A word in one spelling: American, singular."""
    for british, american in SPELLINGS:
        word = word.replace(british, american)
    return word[:-1] if len(word) > 4 and word.endswith("s") and not word.endswith(("ss", "us", "is")) else word


def _abbreviates(short: str, word: str) -> bool:
    """Whether a word's beginning, or some of its letters from the first to the last, are written for it."""
    if len(short) < 2 or len(short) > len(word) - 2 or short[0] != word[0]:
        return False
    if word.startswith(short):
        return True
    rest = iter(word)
    return len(short) > 2 and short[-1] == word[-1] and all(c in rest for c in short)


def _by_length(words: list[str], depth, most: int = 4096) -> Iterator[tuple[list[int], np.ndarray]]:
    """Places of words of one length, and the hashes of what deletions leave of them."""
    lengths: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        lengths[len(w)].append(i)
    for places in lengths.values():
        for low in range(0, len(places), most):
            some = places[low : low + most]
            yield some, _left_over([words[i] for i in some], depth(words[some[0]]))


class _Neighbours:
    """The words of a list within so many edits of a word, by hashes of what deletions leave of both: two arrays.

    ``depth`` gives the edits by a word's length. A hash that others share costs a comparison and changes nothing.
    """

    def __init__(self, words: list[str], depth) -> None:
        self.words, self.depth = words, depth
        parts = [(left.ravel(), np.repeat(np.array(places, np.int32), left.shape[1])) for places, left in _by_length(words, depth)]
        sums = np.concatenate([s for s, _ in parts] or [np.empty(0, np.uint64)])
        order = np.argsort(sums, kind="stable")
        self.sums, self.owners = sums[order], np.concatenate([o for _, o in parts] or [np.empty(0, np.int32)])[order]
        self.longest = max(map(len, words), default=0)

    def of(self, words: list[str]) -> dict[str, list[tuple[str, int]]]:
        """For each word (listed word, edits) of all within the lesser of both words' depths, in the list's order."""
        out: dict[str, list[tuple[str, int]]] = {w: [] for w in words}
        words = [w for w in out if 0 < len(w) <= self.longest + self.depth(w)]  # any other is further away from all
        for places, left in _by_length(words, self.depth):
            low, high = np.searchsorted(self.sums, left, "left"), np.searchsorted(self.sums, left, "right")
            near: dict[int, set[int]] = defaultdict(set)
            for row, column in zip(*np.nonzero(low < high), strict=True):
                near[places[row]].update(self.owners[low[row, column] : high[row, column]].tolist())
            for place, owners in near.items():
                word = words[place]
                for i in sorted(owners):
                    most = min(self.depth(word), self.depth(self.words[i]))
                    if (away := edit_distance(word, self.words[i], most)) <= most:
                        out[word].append((self.words[i], away))
        return out


class Reference:
    """The reference list prepared for matching: its names and short forms, and neighbours of the words in them.

    What the list's words mean is learnt from the list: those of more than a hundredth of the entries (of two at least) tell
    kinds of entries, all others name them.
    """

    def __init__(self, entries: list[tuple[int, str | None, str | None, str | None]]) -> None:
        self.kind = {i: (e or "").strip().casefold() for i, _, _, e in entries}
        self.words = {i: _tokens(name)[0] if name else [] for i, name, _, _ in entries}
        by_form: dict[str, set[int]] = defaultdict(set)
        for i, _, short, _ in entries:
            for form in ("".join(self.words[i]), "".join(_tokens(short)[0]) if short else ""):
                if form:
                    by_form[form].add(i)
        self.by_form = {k: sorted(v) for k, v in by_form.items()}
        holders: dict[str, set[int]] = defaultdict(set)
        for i, tokens in self.words.items():
            for t in tokens:
                holders[t].add(i)
        many = max(2, len(self.words) // 100)
        self.shared = {t for t, ids in holders.items() if len(ids) > many and t not in FILLER}  # the words that tell kinds of entries, not entries
        self.spelled = {_spelled(t): t for t in sorted(self.shared)}
        self.naming = {t: sorted(ids) for t, ids in holders.items() if t not in self.shared and t not in FILLER}
        self.weight = {t: 0.0 if t in FILLER else 1.0 if t in self.shared else 3.0 for t in holders}
        self.kinds = set(self.kind.values())
        self.kind_words: dict[str, set[str]] = defaultdict(set)
        for i, tokens in self.words.items():
            self.kind_words[self.kind[i]] |= {t for t in tokens if t in self.shared}
        self.near_naming = _Neighbours(sorted(self.naming), _allowed)
        self.near_shared = _Neighbours(sorted(self.shared), lambda w: int(len(w) > 4))
        self.prefixes: dict[str, list[str]] = defaultdict(list)
        for t in sorted(self.naming):
            for n in range(4, len(t)):
                self.prefixes[t[:n]].append(t)
        self._ready()

    def _ready(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for form, ids in self.by_form.items():
            self.automaton.add_word(form, (form, ids))
        if self.by_form:
            self.automaton.make_automaton()
        self._meant: dict[str, str] = {}
        self._like: dict[str, list[tuple[str, int]]] = {}
        self._kind_like: dict[str, list[tuple[str, int]]] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "automaton" and not k.startswith("_")} | {"near_shared": None}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.near_shared = _Neighbours(sorted(self.shared), lambda w: int(len(w) > 4))
        self._ready()

    def _respelled(self, word: str) -> str:
        """The shared word in the list's spelling, else the word itself."""
        return word if word in self.shared or word in self.naming else self.spelled.get(_spelled(word), word)

    def _word(self, word: str) -> str:
        """The shared word that another spelling, an abbreviation or a salt's symbol stands for, else the word itself."""
        meant = self._meant.get(word)
        if meant is None:
            meant = self._respelled(word)
            if meant not in self.shared and meant not in self.naming:
                full = [t for t in self.shared if _abbreviates(word, t)]
                begun = [t for t in full if t.startswith(word)]
                meant = SALTS[word] if SALTS.get(word) in self.shared else full[0] if len(full) == 1 else begun[0] if len(begun) == 1 else word
            if len(self._meant) > CACHE_VALUES:
                self._meant.clear()
            self._meant[word] = meant
        return meant

    def match(self, value: str, hint: str | None) -> tuple[int, float]:
        """(entry or -1, similarity) of a value; the hint, a kind of entry, tells apart what the value leaves open."""
        words, dotted = _tokens(value)
        if not words:
            return -1, 0.0
        hint = (hint or "").strip().casefold()
        words = [words[0], *map(self._respelled, words[1:])]
        hint = hint if hint in self.kinds else hint.rstrip("s") if hint.rstrip("s") in self.kinds else ""
        found = self._embedded(words)
        if found is not None:
            return self._settle(found, hint, 1.0)
        return self._similar(words, dotted, hint)

    def _embedded(self, words: list[str]) -> list[int] | None:
        """The entries of the longest name or short form that stands in the words, unless other words contradict it."""
        starts, ends, at = {}, {}, 0
        for k, w in enumerate(words):
            starts[at] = k
            at += len(w)
            ends[at] = k
        if not self.by_form:
            return None
        spans = []
        for end, (form, ids) in self.automaton.iter("".join(words)):
            begin = end + 1 - len(form)
            if begin in starts and end + 1 in ends:
                spans.append((begin, end + 1, ids))
        taken: list[tuple[int, int, list[int]]] = []
        for span in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
            if all(span[1] <= t[0] or span[0] >= t[1] for t in taken):
                taken.append(span)
        for begin, end, ids in taken:
            rest = {self._word(w) if k else w for k, w in enumerate(words) if not starts[begin] <= k <= ends[end]}
            if fitting := [i for i in ids if not self._contradicts(rest, i)]:
                return fitting
        return None

    def _contradicts(self, rest: set[str], entry: int) -> bool:
        """Whether words beside an entry's name speak of another kind of entry: those that its kind doesn't use."""
        own = self.kind_words[self.kind[entry]]
        return any(w in self.shared and w not in own for w in rest)

    def _similar(self, words: list[str], dotted: list[bool], hint: str) -> tuple[int, float]:
        """The entry of greatest token-set similarity: its words' weights, each times the likeness of its best partner."""
        read = [_unscan(w) for w in words]
        present = {t for w in read if (t := self._shared_like(w))}
        single = list(zip(read, dotted, strict=True))
        ids, score = self._best(single, present | {t for w in read[1:] if (t := self._word(w)) in self.shared})
        if not ids:  # a name written apart, whose parts aren't abbreviations
            ids, score = self._best([*single, *((read[k] + read[k + 1], False) for k in range(len(read) - 1))], present)
        return self._settle(ids, hint, score) if ids else (-1, score)

    def _best(self, units: list[tuple[str, bool]], present: set[str]) -> tuple[list[int], float]:
        """The entries of greatest similarity, if it is enough, and that similarity."""
        likeness: dict[str, float] = {}
        for unit in units:
            for t, like in self._naming_like(unit).items():
                if like > likeness.get(t, 0.0):
                    likeness[t] = like
        scores: dict[int, float] = {}
        for t in likeness:
            for i in self.naming[t]:
                if i in scores:
                    continue
                total = sum(self.weight[x] for x in self.words[i])
                got = sum(self.weight[x] * (likeness.get(x, 0.0) if x in self.naming else float(x in present or x in FILLER)) for x in self.words[i])
                alien = len(present - set(self.words[i]))
                scores[i] = got / (total + alien)
        good = {i: s for i, s in scores.items() if s >= LEAST_SIMILARITY}
        if not good:
            return [], max(scores.values(), default=0.0)
        top = max(good.values())
        return [i for i, s in good.items() if s >= top - 1e-9], top

    def look_up(self, values: list[str]) -> None:
        """Find the neighbours of all words that matching these values may ask for, together."""
        words: set[str] = set()
        for value in values:
            read = [_unscan(w) for w in _tokens(value)[0]]
            words.update(read)
            words.update(a + b for a, b in zip(read, read[1:], strict=False))
        for known, near in ((self._like, self.near_naming), (self._kind_like, self.near_shared)):
            new = [w for w in words if w not in known]
            if len(known) + len(new) > CACHE_VALUES:
                known.clear()
                new = list(words)
            known.update(near.of(new))

    def _neighbours(self, word: str, known: dict[str, list[tuple[str, int]]], near: _Neighbours) -> list[tuple[str, int]]:
        if word not in known:
            known.update(near.of([word]))
        return known[word]

    def _naming_like(self, unit: tuple[str, bool]) -> dict[str, float]:
        """The naming words that a word, or one cut off with a full stop, is like, and how much."""
        word, dot = unit
        if word in self.shared:
            return {}
        like = dict.fromkeys(self.prefixes.get(word, ()), 0.9 if len(word) >= 5 else 0.8) if dot else {}
        for t, away in self._neighbours(word, self._like, self.near_naming):
            like[t] = max(like.get(t, 0.0), 1 - away / max(len(word), len(t)))
        return like

    def _shared_like(self, word: str) -> str | None:
        """The shared word that this is, or that it is one edit away from."""
        return word if word in self.shared else next((t for t, _ in self._neighbours(word, self._kind_like, self.near_shared)), None)

    def _settle(self, ids: list[int], hint: str, score: float) -> tuple[int, float]:
        if len(ids) > 1 and hint:
            ids = [i for i in ids if self.kind[i] == hint] or ids
        return (ids[0], score) if len(ids) == 1 else (-1, score)


_prepared: dict[str, tuple[Reference, dict]] = {}


def _match_batches(shared, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from loomspan.llm import canonical  # the worker's own module, which outlives the task

        if name not in canonical._prepared:
            canonical._prepared.clear()
            canonical._prepared[name] = shared.value, {}
        reference, known = canonical._prepared[name]
        for batch in batches:
            pairs = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            new = set(pairs) - known.keys()
            if len(known) + len(new) > CACHE_VALUES:
                known.clear()
                new = set(pairs)
            reference.look_up([value for value, _ in new])
            for pair in new:
                known[pair] = reference.match(*pair)
            found = [known[pair] for pair in pairs]
            yield pa.record_batch([batch.column(0), pa.array([i for i, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], names=["key", "canonical_id", "score"])

    return run


def match_values(values: DataFrame, reference: DataFrame, key: str = "alias_id", value: str = "alias", hint: str = "entity") -> DataFrame:
    """(key, canonical_id, score): for every row with a value, the entry that it means, or -1.

    A value means an entry whose name or short form stands in it, compared without case, marks, white space and
    punctuation, shared words in any spelling or abbreviation; of several the longest that doesn't overlap a longer one.
    Words beside it are ignored unless they speak of another kind of entry. Other values are compared word by word in any
    order: words that tell entries apart weigh three times the shared ones, and may differ by two edits (one in words of
    under six letters, none under four), by scanned digits, or by a cut-off end. Of entries with one short form, and of
    equally similar ones, the hint decides; if it can't, the value is unmatched.

    Rows whose value is null or blank have no row; repeated rows and null keys keep theirs. The reference list (fixed; at
    most MAX_ENTRIES) is prepared once and broadcast, its rows without an id or name are left out. Values are matched where
    they lie: nothing is shuffled, so a value that makes up any share of the rows is no bottleneck. A worker matches each
    distinct value once, and looks up the neighbours of each distinct word once, for all of its tasks. Other columns are
    ignored.
    """
    entries = [tuple(r) for r in reference.filter("canonical_id is not null").select("canonical_id", "canonical", "short_form", "entity").orderBy("canonical_id").limit(MAX_ENTRIES + 1).collect()]
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"the reference list has more than {MAX_ENTRIES} entries")
    shared = values.sparkSession.sparkContext.broadcast(Reference(entries))
    kind = values.schema[key].dataType.simpleString()
    rows = values.select(values[key].alias("key"), values[value].cast("string").alias("value"), values[hint].cast("string").alias("hint")).filter("value rlike '(?U)\\\\S'")
    return rows.mapInArrow(_match_batches(shared, uuid.uuid4().hex), f"key {kind}, canonical_id bigint, score double").withColumnRenamed("key", key)


def unmatched(values: DataFrame, matched: DataFrame, key: str = "alias_id", value: str = "alias") -> DataFrame:
    """(value, n): the values that mean no entry, with their number of rows."""
    none = matched.filter("canonical_id = -1").select(key)
    return values.join(none, key, "left_semi").groupBy(value).count().withColumnRenamed("count", "n")
