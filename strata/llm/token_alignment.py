"""Alignment of two tokenizers' tokens over the same bytes, by galloping intersection.

1. A text with one space in front is tokenized by a byte-level vocabulary (A) and by a
   piece vocabulary that adds that space itself (B), without special tokens.  Tokens
   are spans of bytes; each side is the rising list of its tokens' end offsets.
2. The shorter end list drives: each of its ends is looked up in the longer one by steps
   that double from the last place found, then by binary search in the last step.
   Common ends cut both token lists into groups.
3. Inside a group, the rank of a token's start and end among the other side's ends gives
   the range of tokens that it overlaps: the links.
4. Links are counted by pair of ids over the whole corpus, each document's own equal links
   being summed first.  Documents' links then meet the counts, which are a table of their
   own, in a join: Spark broadcasts it while it is smaller than its threshold, and merges
   both sides by pair otherwise.

Both vocabularies break before a lone space or line end between two other characters,
where the loaded files confirm it; there a text is cut into stretches, and a worker
remembers the groups and links of those it met lately.  Files whose tokens may cross these
places are run over whole texts.

Defined results: a null or empty text has no tokens, nor has one whose A or B tokens don't
spell the text (such as one that holds U+2581, which B reads as a space): zeros, no groups.
Texts of any length are processed whole, a text without such breaks as one stretch.
Repeated rows and null ids give a row each; an empty table gives none; other columns are
not read.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import alone, by_bytes, cut, ready, remembers

SPACE = "▁"
#: Stretches that a worker remembers, and the longest of them.
CACHE_STRETCHES, CACHE_CHARS = 240_000, 64
#: New stretches that A reads laid end to end.
TOGETHER = 50


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable bytes
    for themselves, the others for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


# -- the intersection ------------------------------------------------------------

def gallop(few: np.ndarray, many: np.ndarray, low: np.ndarray) -> np.ndarray:
    """How many of the rising ``many`` are smaller than each of ``few``, of which at least
    ``low`` are: steps that double from there, then binary search in the last step.  All
    of ``few`` take their next step together."""
    low, high = low.copy(), low.copy()
    step = np.ones_like(low)
    todo = np.flatnonzero(high < len(many))
    while len(todo):
        todo = todo[many[high[todo]] < few[todo]]
        low[todo] = high[todo] + 1
        high[todo] += step[todo]
        step[todo] *= 2
        todo = todo[high[todo] < len(many)]
    high = np.minimum(high, len(many))
    todo = np.flatnonzero(low < high)
    while len(todo):
        middle = (low[todo] + high[todo]) // 2
        smaller = many[middle] < few[todo]
        low[todo[smaller]] = middle[smaller] + 1
        high[todo[~smaller]] = middle[~smaller]
        todo = todo[low[todo] < high[todo]]
    return low


@dataclass
class Aligned:
    """Groups and links of tokens whose ends are given.  ``common_few``, ``common_many``:
    which tokens end where one of the other side ends too, that is, end a group.
    ``first``, ``last``: the other side's tokens that each driving token overlaps."""
    common_few: np.ndarray
    common_many: np.ndarray
    first: np.ndarray
    last: np.ndarray


def intersect(few: np.ndarray, many: np.ndarray, low: np.ndarray) -> Aligned:
    """The shorter side ``few`` drives.  A token's rank is that of its end; from the rank
    of the token before and its own follow the tokens that share bytes with it."""
    rank = gallop(few, many, low)
    common = np.zeros(len(few), bool)
    inside = rank < len(many)
    common[inside] = many[rank[inside]] == few[inside]
    other = np.zeros(len(many), bool)
    other[rank[common]] = True
    first = np.concatenate([[0], rank[:-1] + common[:-1]]).astype(np.int64)
    return Aligned(common, other, first, rank)


def _spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each of ``counts`` rows."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


# -- tokenizers ------------------------------------------------------------------

def _flat(tokens: list[list[int]]) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(tokens), np.int64)


def _lengths(items: list) -> np.ndarray:
    return np.fromiter(map(len, items), np.int64, len(items))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sums of the first ``counts[0]`` values, of the next ``counts[1]``, .."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], np.cumsum(counts)])])


def _pick(values: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The values of some ``rows``, of which each has ``counts`` values, laid end to end."""
    own = counts[rows]
    return values[np.repeat(_starts(counts)[rows], own) + _spread(own)]


@dataclass
class Stretches:
    """Results of stretches: for each its groups as text (empty where the tokens don't
    spell it), its numbers of tokens of A, of B and of links, and, laid end to end, the
    links as a << 32 | b."""
    groups: list[str]
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    links: np.ndarray

    def rows(self, rows: np.ndarray) -> Stretches:
        return Stretches(list(map(self.groups.__getitem__, rows.tolist())), self.n_a[rows], self.n_b[rows],
                         self.n_links[rows], _pick(self.links, self.n_links, rows))

    def __add__(self, other: Stretches) -> Stretches:
        return Stretches(self.groups + other.groups, *(np.concatenate(two) for two in (
            (self.n_a, other.n_a), (self.n_b, other.n_b), (self.n_links, other.n_links), (self.links, other.links))))


class Aligner:
    """Both tokenizers, with the stretches that were met lately."""

    def __init__(self, a_json: str, b_model: bytes, cache: int = CACHE_STRETCHES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in alphabet for c in token)
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        ab = self.a.pre_tokenizer.pre_tokenize_str(" ab cd\nef") if self.a.pre_tokenizer else []
        self.a_size, self.b_size = _lengths(self.a_bytes), _lengths(self.b_bytes)
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.told = {mark: np.array([f"{i}{mark}" for i in range(most)], object) for mark in ",|;\n"}
        self.breaks = (
            self.a.normalizer is None and [at for _, at in ab] == [(0, 3), (3, 6), (6, 7), (7, 9)]
            and self.b.normalize(" a  ① ") == SPACE * 2 + "a" + SPACE * 2 + "①" + SPACE
            and not any(re.search(f"[^{SPACE}]{SPACE}|\\n", p) for p in pieces))
        self.cache = cache
        # The remembered stretches by their places in ``known``, and the call that met each last.
        self.place: dict[str, int] = {}
        none = np.empty(0, np.int64)
        self.known, self.met, self.call = Stretches([], none, none, none, none), none, 0

    #: Before a lone space or line end between two other characters.
    BREAK = re.compile(r"(?<=\S)(?=[ \n]\S)")

    def stretches(self, text: str) -> list[str]:
        """The parts of " " + text.  One that starts with a space before another
        character is named without that space."""
        if not self.breaks:
            return [" " + text if text[0] in " \n" else text]
        if " ".join(text.split()) == text.replace("\n", " "):
            return text.replace("\n", " \n").split(" ")
        return [p[1:] if p[0] == " " and p[1] not in " \n" else p for p in self.BREAK.split(" " + text)]

    def learn(self, names: list[str]) -> Stretches:
        full = [n if n[0] in " \n" else " " + n for n in names]
        raw = [f.encode() for f in full]
        a, n_a = self._tokens_a(full, _lengths(raw))
        tokens_b = self.b.encode([f[1:] if f[0] == " " else f for f in full], num_threads=1)
        tokens_b = [b[1:] if f[0] == "\n" else b for f, b in zip(full, tokens_b)]  # not the space that B puts in front
        b, n_b = _flat(tokens_b), _lengths(tokens_b)
        spelt = self._spelt(raw, ((self.a_bytes, self.a_size, a, n_a), (self.b_bytes, self.b_size, b, n_b)))
        # The shorter list drives: stretches with fewer tokens of A, and the others.
        rows, found = [np.flatnonzero(~spelt)], []
        none = np.zeros(len(rows[0]), np.int64)
        found.append(Stretches([""] * len(none), none, none, none, none[:0]))
        for a_drives in (True, False):
            own = np.flatnonzero(spelt & ((n_a <= n_b) == a_drives))
            if len(own):
                rows.append(own)
                found.append(self._aligned(_pick(a, n_a, own), n_a[own], _pick(b, n_b, own), n_b[own], a_drives))
        return sum(found[1:], found[0]).rows(np.argsort(np.concatenate(rows)))

    def _tokens_a(self, full: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A's tokens of all stretches, and their numbers in each.  A reads stretches laid
        end to end where a break is between them, as it costs less than one by one."""
        encode = lambda texts: [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        if self.breaks:
            apart = np.array([f[-1].isspace() or f[1].isspace() for f in full], bool)
            begins = np.arange(len(full)) % TOGETHER == 0
            begins[1:] |= apart[1:] | apart[:-1]
            at = [*np.flatnonzero(begins).tolist(), len(full)]
            a = _flat(encode(["".join(full[x:y]) for x, y in zip(at, at[1:])]))
            ends, wanted = np.cumsum(self.a_size[a]), np.cumsum(size)
            last = np.searchsorted(ends, wanted)
            if len(a) and ends[-1] == wanted[-1] and (ends[last] == wanted).all():
                return a, np.diff(last, prepend=-1)
        tokens = encode(full)
        return _flat(tokens), _lengths(tokens)

    def _spelt(self, raw: list[bytes], sides: tuple) -> np.ndarray:
        """Whether both sides' tokens spell each stretch."""
        good = np.ones(len(raw), bool)
        for _, sizes, tokens, n in sides:
            good &= _sums(sizes[tokens], n) == _lengths(raw)
        for table, _, tokens, n in sides:
            spell = lambda own: b"".join(map(table.__getitem__, own.tolist()))  # noqa: B023, E731
            if spell(tokens[np.repeat(good, n)]) != b"".join(itertools.compress(raw, good)):
                at = _starts(n)
                for k in np.flatnonzero(good).tolist():
                    good[k] = spell(tokens[at[k]:at[k] + n[k]]) == raw[k]
        return good

    def _aligned(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, a_drives: bool) -> Stretches:
        """Groups and links of stretches with ``n_a`` and ``n_b`` of the tokens.  Laid end
        to end, the stretches are one text; each ends a group, so none reaches into the next."""
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        if a_drives:
            found = intersect(ends_a, ends_b, np.repeat(_starts(n_b), n_a))
            common_a, common_b, few, n_few = found.common_few, found.common_many, a, n_a
        else:
            found = intersect(ends_b, ends_a, np.repeat(_starts(n_a), n_b))
            common_a, common_b, few, n_few = found.common_many, found.common_few, b, n_b
        width = found.last - found.first + 1
        other = (b if a_drives else a)[np.repeat(found.first, width) + _spread(width)]
        driver = np.repeat(few, width)
        links = (driver << 32 | other) if a_drives else (other << 32 | driver)

        # A group's A tokens, then its B tokens: "a1,a2|b1;", or a line end where its stretch ends.
        of_a, of_b = np.cumsum(common_a) - common_a, np.cumsum(common_b) - common_b
        size_a, size_b = np.bincount(of_a), np.bincount(of_b)
        told = np.empty(len(a) + len(b), object)
        told[np.arange(len(a)) + _starts(size_b)[of_a]] = np.where(common_a, self.told["|"][a], self.told[","][a])
        place_b = np.arange(len(b)) + np.cumsum(size_a)[of_b]
        told[place_b] = np.where(common_b, self.told[";"][b], self.told[","][b])
        last = np.cumsum(n_b) - 1
        told[place_b[last]] = self.told["\n"][b[last]]
        return Stretches("".join(told.tolist()).split("\n")[:-1], n_a, n_b, _sums(width, n_few), links)

    def read(self, texts: list[str]) -> tuple[Stretches, np.ndarray]:
        """The stretches' results, text by text, and the number of stretches in each.  A
        text that the tokens don't spell has none, as an empty one."""
        names = [self.stretches(t) if t else [] for t in texts]
        flat, n = list(itertools.chain.from_iterable(names)), _lengths(names)
        new = [s for s in dict.fromkeys(flat) if s not in self.place]
        short = [s for s in new if len(s) <= CACHE_CHARS]
        kept = len(self.place) + len(short)
        for own in (short, [s for s in new if len(s) > CACHE_CHARS]):
            if own:
                self.place.update(zip(own, range(len(self.place), len(self.place) + len(own))))
                self.known += self.learn(own)
        place = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        self.call += 1
        self.met = np.concatenate([self.met, np.zeros(len(self.place) - len(self.met), np.int64)])
        self.met[place] = self.call
        spelt = _sums(self.known.n_a[place] == 0, n) == 0
        found = self.known.rows(place[np.repeat(spelt, n)]), np.where(spelt, n, 0)
        self._forget(kept)
        return found

    def _forget(self, kept: int) -> None:
        """All but the first ``kept`` stretches, the short ones; where these are too many,
        all but the half of the cache that was met last."""
        rows = np.arange(kept)
        if kept > self.cache:
            rows = np.sort(np.argsort(-self.met[:kept], kind="stable")[:self.cache // 2])
        if len(rows) < len(self.place):
            names = list(self.place)
            self.place = {names[k]: i for i, k in enumerate(rows.tolist())}
            self.known, self.met = self.known.rows(rows), self.met[rows]

    def of(self, texts: list[str]) -> Iterator[list[tuple] | None]:
        """The stretches' results of each text: groups, links as bytes, numbers of tokens.
        None where the tokens don't spell it."""
        found, n = self.read(texts)
        reach, at = np.concatenate([[0], np.cumsum(found.n_links)]).tolist(), 0
        n_a, n_b = found.n_a.tolist(), found.n_b.tolist()
        for text, own in zip(texts, n.tolist()):
            yield None if text and not own else [
                (found.groups[k], found.links[reach[k]:reach[k + 1]].tobytes(), n_a[k], n_b[k]) for k in range(at, at + own)]
            at += own


@lru_cache(maxsize=2)
def aligner(a_json: str, b_model: bytes) -> Aligner:
    """One for each worker process."""
    return Aligner(a_json, b_model)


remembers("token_alignment", aligner.cache_clear)


# -- Spark -----------------------------------------------------------------------

ALIGNED = ("doc_id long, n_a long, n_b long, groups string, n_links long, "
           "a array<int>, b array<int>, times array<int>")


def _rows(ids: pa.Array, found: Stretches, n: np.ndarray) -> pa.RecordBatch:
    """One row for each text, of which each has ``n`` of the stretches."""
    n_links, at = _sums(found.n_links, n), [0, *np.cumsum(n).tolist()]
    # A text's distinct links: numbers that hold the text's place and both ids.
    a, b = found.links >> 32, found.links & 0xFFFFFFFF
    most_a, most_b = int(a.max(initial=0)) + 1, int(b.max(initial=0)) + 1
    distinct, times = np.unique((np.repeat(np.arange(len(n)), n_links) * most_a + a) * most_b + b, return_counts=True)
    row, pair = np.divmod(distinct, most_a * most_b)
    offsets = pa.array(np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32))
    listed = lambda v: pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32)))
    return pa.RecordBatch.from_arrays([
        ids, pa.array(_sums(found.n_a, n)), pa.array(_sums(found.n_b, n)),
        pa.array([";".join(found.groups[x:y]) for x, y in zip(at, at[1:])], pa.string()), pa.array(n_links),
        listed(pair // most_b), listed(pair % most_b), listed(times)],
        names=["doc_id", "n_a", "n_b", "groups", "n_links", "a", "b", "times"])


def _align(a_json: Broadcast, b_model: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    alone("token_alignment")
    own = aligner(a_json.value, b_model.value)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        ids = batch.column("doc_id").cast(pa.int64())
        at = 0
        for part in by_bytes(texts, size=lambda t: len(t or "")):
            yield _rows(ids[at:at + len(part)], *own.read(part))
            at += len(part)


def alignments(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """(doc_id, text) -> doc_id, n_a, n_b, groups (`a1,a2|b1;a3|b2,b3`: ids of each
    group), n_links, and its distinct links as arrays a, b with the times each occurs.
    One pass; the vocabulary files are read on the driver and handed to the workers."""
    spark = docs.sparkSession
    ready(spark)
    with open(a_file, encoding="utf-8") as a, open(b_file, "rb") as b:
        files = spark.sparkContext.broadcast(a.read()), spark.sparkContext.broadcast(b.read())
    return docs.select("doc_id", "text").mapInArrow(partial(_align, *files), ALIGNED)


def pair_counts(links: DataFrame) -> DataFrame:
    """(a, b, times) -> (a, b, count, best): how often the pair occurs, and whether no
    other pair of its b occurs more often."""
    counts = cut(links.groupBy("a", "b").agg(F.sum("times").alias("count")), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    # A table, so that Spark knows how large it is before it joins the links.
    return cut(counts.join(highest, "b").select(
        "a", "b", "count", (F.col("count") == F.col("highest")).alias("best")), "pairs")


def digests(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    n_groups = F.when(F.col("groups") == "", 0).otherwise(
        F.octet_length("groups") - F.octet_length(F.replace("groups", F.lit(";"), F.lit(""))) + 1)
    rows = cut(alignments(docs, a_file, b_file).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", n_groups.cast("long").alias("n_groups"), "n_links",
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"), "a", "b", "times"), "links")
    links = rows.select("row", F.inline(F.arrays_zip("a", "b", "times")))
    sums = links.join(pair_counts(links), ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.drop("a", "b", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
