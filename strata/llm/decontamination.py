"""Benchmark passages in documents by winnowing, in DataFrame functions only.

1. Texts become words (A-Z lowered; digits, a-z and all non-ASCII characters).
2. Each run of GRAM words is hashed; of every GRAMS neighbouring hashes the
   smallest is a fingerprint (leftmost on ties).  GRAMS runs of GRAM words span
   exactly WINDOW words, so two texts that share WINDOW words in a row share a
   fingerprint at the same place of that span.
3. Document fingerprints are joined to those of the benchmark (a plain join: Spark
   broadcasts the benchmark's only where it measures them as small).
   That says at which places of a document a window may begin, whatever the item.
4. The hits are extended: at these places the document's windows are written out, a
   bounded chunk of words at a time, and compared word by word with the items' windows.
   Which words are hit, and which items occur, are told apart only after that, from
   windows that are really shared; so a word that fills a text, or a phrase that many
   items and documents share, gives a row for each place and not one for each pair.

Items of fewer than WINDOW words, but not none, are one window each.  They are
found by the hash of their first words, at every place of the documents; lengths
are put into classes, so that this costs one pass for each class that occurs.

Defined results: a null or empty text has no words and is clean.  Items without
words, and rows with a null item_id, match nothing; rows that repeat an item_id
are one item with the windows of all its texts.  Documents are told apart by
doc_id and text, so repeated rows, and null ids, each get their own right row.
Texts are processed whole, long and repetitive ones too: what a task holds of a text
at once is its words, and the windows of one chunk of CHUNK words.  Empty tables give no
rows, or clean documents.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, let

WINDOW = 13
GRAM = 7
GRAMS = WINDOW - GRAM + 1
#: Of 20 words, one hit makes a document contaminated.
SHARE = 20
#: Smallest length of each class of short items.
SHORT_CLASSES = (1, 2, 4, 8)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLACE_BITS = 31
#: Words of a document that are compared at once.
CHUNK = 4096
KEYS = ["doc_id", "text_hash"]


def words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    # lower() also changes other letters; texts without any take its fast way.
    plain = F.octet_length(text) == F.char_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _placed(hashed: Column, place: Column) -> Column:
    """A hash's upper bits with the place below, so that the least is the
    smallest hash, leftmost on ties."""
    return F.shiftleft(F.shiftright(hashed, PLACE_BITS), PLACE_BITS).bitwiseOR(place)


def _grams(w: Column, length: int) -> Column:
    """Hash and place of every run of ``length`` words."""
    return F.when(F.size(w) >= length, F.transform(
        F.sequence(F.lit(1), F.size(w) - (length - 1)),
        lambda i: _placed(F.xxhash64(F.slice(w, i, length)), i.cast("long"))))


def _grams_of(column: str, length: int) -> Column:
    return let(F.col(column), lambda w: _grams(w, length))


def _fingerprints(grams: Column) -> Column:
    """The smallest of each GRAMS neighbouring grams."""
    return F.when(F.size(grams) >= GRAMS, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(grams) - (GRAMS - 1)),
        lambda i: F.array_min(F.slice(grams, i, GRAMS)))))


def _rows(df: DataFrame, keys: list[str], marks: Column) -> DataFrame:
    """One row for each fingerprint, with its hash and place."""
    g = F.col("g")
    return df.select(*keys, F.explode(marks).alias("g")).select(
        *keys, F.shiftright(g, PLACE_BITS).alias("hash"),
        g.bitwiseAND(F.lit(2**PLACE_BITS - 1)).cast("int").alias("place"))


def _item_windows(items: DataFrame) -> DataFrame:
    """(item_id, length, window): every window of every item, as text."""
    spans = let(F.col("words"), lambda w: let(F.least(F.size(w), F.lit(WINDOW)), lambda n: F.transform(
        F.sequence(F.lit(1), F.size(w) - n + 1),
        lambda i: F.struct(n.alias("length"), F.array_join(F.slice(w, i, n), " ").alias("window")))))
    return items.where(F.size("words") > 0).select("item_id", F.inline(spans)).distinct()


def _starts(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, dict[int, list[int]]]:
    """(doc_id, text_hash, kind, start): places of the documents where windows of a
    kind may begin, and each kind's lengths of windows."""
    marked = let(F.col("words"), lambda w: let(_grams(w, GRAM), _fingerprints))
    some = lambda rows: rows.select("hash").distinct()
    long_items = items.where(F.size("words") >= WINDOW)
    found = _rows(docs, KEYS, marked).join(some(_rows(long_items, ["item_id"], marked)), "hash", "left_semi")
    out = found.select(*KEYS, F.lit(WINDOW).alias("kind"), F.explode(F.sequence(
        F.greatest(F.lit(1), F.col("place") - (WINDOW - GRAM)), "place")).alias("start"))
    kinds = {WINDOW: [WINDOW]}

    short = items.where(F.size("words").between(1, WINDOW - 1))
    lengths = sorted(r[0] for r in short.select(F.size("words")).distinct().collect())
    for low, high in zip(SHORT_CLASSES, (*SHORT_CLASSES[1:], WINDOW)):
        own = [n for n in lengths if low <= n < high]
        if not own:
            continue
        kinds[own[0]] = own
        firsts = short.where(F.size("words").isin(own)).select(
            F.shiftright(F.xxhash64(F.slice("words", 1, own[0])), PLACE_BITS).alias("hash"))
        places = _rows(docs, KEYS, _grams_of("words", own[0])).join(some(firsts), "hash", "left_semi")
        out = out.unionByName(places.select(*KEYS, F.lit(own[0]).alias("kind"), F.col("place").alias("start")))
    return out, kinds


def _windows(opened: DataFrame, kinds: dict[int, list[int]]) -> DataFrame:
    """(.., text, at) -> (doc_id, text_hash, n_words, start, length, window): the documents'
    windows at their places.  Each chunk gets a row with its own words first."""
    x = F.col("part")
    chunks = opened.select(*KEYS, F.explode(let(words(F.col("text")), lambda w: F.transform("at", lambda a: F.struct(
        a["kind"].alias("kind"), a["chunk"].alias("chunk"), a["starts"].alias("starts"), F.size(w).alias("n_words"),
        F.slice(w, a["chunk"] * CHUNK + 1, CHUNK + WINDOW - 1).alias("words"))))).alias("part"))
    spans = lambda n: F.transform(x["starts"], lambda s: F.struct(
        s.alias("start"), F.lit(n).alias("length"),
        F.array_join(F.slice(x["words"], s - x["chunk"] * CHUNK, n), " ").alias("window")))
    every = F.lit(None)
    for kind, lengths in kinds.items():
        every = F.when(x["kind"] == kind, F.concat(*[spans(n) for n in lengths])).otherwise(every)
    return chunks.select(*KEYS, x["n_words"].cast("long").alias("n_words"), F.inline(every))


def _covered(hits: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit): words inside any hit, each counted once."""
    own = Window.partitionBy(*KEYS).orderBy("start", "length")
    end = F.col("start") + F.col("length") - 1
    before = F.max(end).over(own.rowsBetween(Window.unboundedPreceding, -1))
    new = end - F.greatest(F.coalesce(before, F.lit(0)), F.col("start") - 1)
    return hits.select(*KEYS, "n_words", F.greatest(new, F.lit(0)).alias("new")).groupBy(*KEYS, "n_words").agg(
        F.sum("new").alias("n_hit"))


def _same_text(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["d"]) & (left["text_hash"] == right["h"])


def _named(found: DataFrame) -> DataFrame:
    return found.withColumnsRenamed({"doc_id": "d", "text_hash": "h"})


def hits(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(d, h, n_words, n_hit, ids) of the documents that share a window with an item: their
    doc_id and hash of the text, and the items' ids as sorted text."""
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    items = benchmark.where("item_id is not null").select("item_id", words(F.col("text")).alias("words"))
    windows = _item_windows(items)

    starts, kinds = _starts(texts.select("doc_id", "text_hash", words(F.col("text")).alias("words")), items)
    chunk = F.floor((F.col("start") - 1) / CHUNK).cast("int")
    places = starts.groupBy(*KEYS, "kind", chunk.alias("chunk")).agg(F.collect_set("start").alias("starts"))
    places = _named(cut(places.groupBy(*KEYS).agg(
        F.collect_list(F.struct("kind", "chunk", "starts")).alias("at")), "places"))
    # A merge join at every size: texts are dealt out once, however many have places.
    opened = texts.join(places.hint("merge"), _same_text(texts, places)).select("doc_id", "text_hash", "text", "at")

    shared = windows.select("length", "window").distinct()
    hit = cut(_windows(opened, kinds).join(shared, ["length", "window"], "left_semi").distinct(), "hits")
    covered = _covered(hit)
    named = hit.select(*KEYS, "length", "window").distinct().join(windows, ["length", "window"]).groupBy(
        F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    return _named(covered.join(named, _same_text(covered, named)).select(*KEYS, "n_words", "n_hit", "ids"))


def _contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (SHARE * n_hit >= n_words)


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text) and (item_id, text) -> doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated; one row per row of ``documents``."""
    found = cut(hits(documents, benchmark).drop("n_words"), "found")
    texts = documents.select("doc_id", F.xxhash64("text").alias("text_hash"),
                             F.size(words(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return texts.join(found, _same_text(texts, found), "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        _contaminated(n_hit, F.col("n_words")).alias("contaminated"))


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that aren't contaminated, with all their columns."""
    found = hits(documents, benchmark)
    bad = cut(found.where(_contaminated(F.col("n_hit"), F.col("n_words"))).select("d", "h"), "contaminated")
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["d"]) & (F.xxhash64(documents["text"]) == bad["h"]), "left_anti")
