"""Exact merge-type SentencePiece encoding by backtracking, and decoding.

A merge vocabulary joins the adjacent pair whose concatenation has the best
score (leftmost on ties) until no pair is in the vocabulary.  The same result
is found without a merge queue:

* an Aho-Corasick pass over the text gives the longest piece at each position;
* two pieces may stand side by side only if re-merging their characters gives
  exactly these two pieces back (checked once per pair, then remembered); a
  sequence is the merge result if all its neighbours are compatible;
* walking left to right, a piece that doesn't fit is replaced by its next
  shorter prefix; where none is left, the position is marked failed in a
  bitfield, and the previous piece is shortened instead.

Spaces become U+2581 with one in front of the text.  Where no piece of the
vocabulary has U+2581 after another character, or a line end, no merge crosses
these, so words are encoded apart and their ids remembered in each worker.

Defined results: a null text is an empty one and has no ids; empty texts, very
long ones, repeated rows, empty tables and further columns are plain cases
(one output row per input row, ids and text only are read).  Models must be
of the merge type with byte fallback and leave text as it is (identity
normalisation, no space removal); others raise ``ValueError``.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import ahocorasick
import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame

from strata.llm.common import alone, ready, remembers

SPACE = "▁"
#: Words in each of a worker's two generations of remembered words.
CACHE_WORDS = 300_000


class Codec:
    def __init__(self, model_file: str, cache_words: int = CACHE_WORDS):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if sp.normalize(" a  ① ") != SPACE * 2 + "a" + SPACE * 2 + "①" + SPACE:
            raise ValueError("the model changes text before it splits it")
        self.score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        self.surface: list[bytes | None] = []
        self.raw: dict[int, int] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw[i] = int(piece[3:5], 16)
                self.surface.append(None)
            elif sp.is_control(i) or sp.is_unknown(i):
                self.surface.append(" ⁇ ".encode() if sp.is_unknown(i) else b"")
            else:
                self.ids[piece], self.score[piece] = i, sp.get_score(i)
                self.surface.append(piece.replace(SPACE, " ").encode())
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no byte fallback")
        # Merges never cross a word start or a line end that no piece holds inside.
        whole = any(re.search(f"[^{SPACE}]{SPACE}|\\n", p) for p in self.ids)
        self.part = re.compile("(?s).+" if whole else f"{SPACE}*[^{SPACE}\\n]+|{SPACE}+|\\n")
        # Pieces that merging really makes, each one's next shorter prefix (-1: none).
        made = {p: i for p, i in self.ids.items() if self.merge(p) == [p]}
        self.made, self.length, self.shorter = {i: p for p, i in made.items()}, {}, {}
        self.automaton = ahocorasick.Automaton()
        for p, i in made.items():
            self.length[i] = len(p)
            self.shorter[i] = next((made[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in made), -1)
            self.automaton.add_word(p, (len(p) - 1, i))
        self.automaton.make_automaton()
        self.kind = np.uint16 if len(self.surface) <= 2**16 else np.uint32
        self.digits = [str(i) for i in range(len(self.surface))]
        self.pairs: dict[int, bool] = {}
        self.cache_words = cache_words
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """Plain merging of a short string, for pieces and pairs of them."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts))) + [-1]
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (s := self.score.get(parts[i] + parts[j])) is not None:
                heapq.heappush(queue, (-s, i, j, parts[i] + parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or parts[i] + parts[j] != both or after[i] != j:
                continue
            parts[i], parts[j], after[i] = both, None, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None]

    def compatible(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= self.cache_words:
                self.pairs.clear()
            a, b = self.made[left], self.made[right]
            known = self.pairs[pair] = self.merge(a + b) == [a, b]
        return known

    def split(self, text: str) -> list[int]:
        """The ids of ``text``; characters outside the vocabulary give byte ids."""
        # Matches come by rising end, so the last one of a start is its longest.
        longest = {end - reach: i for end, (reach, i) in self.automaton.iter(text)}
        length, shorter, pairs = self.length, self.shorter, self.pairs
        size, at, out, failed = len(text), 0, [], bytearray(len(text) + 1)
        last, piece = -1, longest.get(0, -1)
        while at < size:
            if piece < 0 and not failed[at] and at not in longest:
                last = -1
                out.append(text[at])  # unknown character: merges with nothing
                at += 1
                piece = longest.get(at, -1)
                continue
            while piece >= 0:
                end = at + length[piece]
                if not failed[end] and (last < 0 or pairs.get(last << 32 | piece) or self.compatible(last, piece)):
                    break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at, last = end, piece
                piece = longest.get(at, -1)
            else:
                failed[at] = 1
                piece = out.pop()
                at -= length[piece]
                piece = shorter[piece]
                last = out[-1] if out and isinstance(out[-1], int) else -1
        ids: list[int] = []
        for x in out:
            ids.extend((x,) if isinstance(x, int) else (self.byte_ids[b] for b in x.encode()))
        return ids

    def _word(self, word: str) -> bytes:
        """A word's ids as bytes.  Two generations of words are remembered: what was
        used since the last turn outlives the next one."""
        known = self.old.get(word)
        if known is None:
            known = np.array(self.split(word), self.kind).tobytes()
        if len(self.young) >= self.cache_words:
            self.old, self.young = self.young, {}
        self.young[word] = known
        return known

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        known, word = self.young.get, self._word
        parts = self.part.findall(SPACE + text.replace(" ", SPACE))
        found = list(map(known, parts))
        if None in found:
            found = [f or self.young.get(w) or word(w) for f, w in zip(found, parts)]
        return np.frombuffer(b"".join(found), self.kind).tolist()

    def listed(self, ids: list[int]) -> str:
        """Decimal ids, joined by commas."""
        return ",".join(map(self.digits.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        parts = list(map(self.surface.__getitem__, ids))
        bare = bool(ids) and parts[0] is not None
        if None in parts:
            parts = self._with_bytes(ids, parts)
        text = b"".join(parts).decode()
        return text[1:] if bare and text.startswith(" ") else text

    def _with_bytes(self, ids: list[int], parts: list[bytes | None]) -> list[bytes]:
        """Runs of byte pieces as UTF-8; a byte that starts no character: U+FFFD."""
        out, run = [], bytearray()
        for i, p in zip([*ids, -1], [*parts, b""]):
            if p is None:
                run.append(self.raw[i])
                continue
            while run:
                try:
                    out.append(bytes(run).decode().encode())
                    run.clear()
                except UnicodeDecodeError as e:
                    out += [bytes(run[: e.start]), "�".encode()]
                    del run[: e.start + 1]
            out.append(p)
        return out


@lru_cache(maxsize=2)
def codec(model_file: str) -> Codec:
    """One codec, with its remembered words, for each worker process."""
    return Codec(model_file)


remembers("sentencepiece", codec.cache_clear)


def _encode(model_file: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    alone("sentencepiece")
    c = codec(model_file)
    for pdf in batches:
        yield pdf[["doc_id"]].assign(ids=[c.encode(t or "") for t in pdf["text"]])


def _decode(model_file: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    alone("sentencepiece")
    c = codec(model_file)
    for pdf in batches:
        yield pdf[["doc_id"]].assign(text=[c.decode(list(i) if i is not None else []) for i in pdf["ids"]])


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) -> (doc_id, ids)."""
    ready(docs.sparkSession)
    return docs.select("doc_id", "text").mapInPandas(
        partial(_encode, model_file), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text)."""
    ready(tokens.sparkSession)
    return tokens.select("doc_id", "ids").mapInPandas(
        partial(_decode, model_file), "doc_id long, text string")


def _digests(model_file: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    alone("sentencepiece")
    c = codec(model_file)
    for pdf in batches:
        rows = []
        for text in pdf["text"]:
            ids = c.encode(text or "")
            rows.append((len(ids), hashlib.sha256(c.listed(ids).encode()).hexdigest(),
                         hashlib.sha256(c.decode(ids).encode()).hexdigest()))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [r[0] for r in rows],
                            "ids_sha256": [r[1] for r in rows],
                            "decoded_sha256": [r[2] for r in rows]})


def round_trip_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the text that
    decoding these ids gives.  One pass, nothing is shuffled."""
    ready(docs.sparkSession)
    return docs.select("doc_id", "text").mapInPandas(
        partial(_digests, model_file),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
