"""Benchmark decontamination by winnowing, in DataFrame functions only.

Both sides are cut into words.  Over every window of `span` words the smallest hash of its `gram`-word grams is the
window's fingerprint; equal windows have equal fingerprints, so every shared span of `span` words is found.  The
distinct fingerprints of a document are joined with those of the benchmark, each hit is extended to the document's
windows that carry the fingerprint, and a window counts only if its words are a benchmark window's words.

Defined results: null texts have no words; an item of fewer than `span` words is one window; an item with a null
item_id marks words but is not named; repeated rows each get their own, equal, row; extra columns are ignored; an empty
benchmark contaminates nothing, and an empty table of documents gives no rows.  A text is read whole however long it is: its words
are one array in one task, a few times the text's size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, let, small, written

#: What parts words, once A-Z are lower case: all of ASCII but letters and digits.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN, GRAM = 10, 5
#: Benchmark windows up to which they are sent to every executor.
BROADCAST_WINDOWS = 200_000


def words(text: Column) -> Column:
    """The words of a text.  Splitting is linear; regexp_extract_all copies the text for every match."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), "")


def _runs(w: Column, first: Column | int, n: Column, body) -> Column:
    """body(i) for i from 1 to n - first + 1, or an empty array."""
    return F.when(n >= first, F.transform(F.sequence(F.lit(1), n - first + 1), body))


def grams(w: Column, k: int) -> Column:
    """The hashes of the k-word grams, or null if there is none."""
    return _runs(w, k, F.size(w), lambda i: F.xxhash64(F.slice(w, i, k)))


def minima(w: Column, g: Column, span: int, k: int) -> Column:
    """The fingerprint of each window of span words, the smallest of its grams' hashes g with the span mixed in; none if it is longer."""
    none = F.array().cast("array<bigint>")
    return F.coalesce(_runs(w, span, F.size(w), lambda i: F.array_min(F.slice(g, i, span - k + 1)).bitwiseXOR(F.lit(span * 0x9E3779B97F4A7C1))), none)


def benchmark_windows(items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(span, f, window, item_id): the distinct windows of all items with their fingerprints."""
    w = items.select("item_id", words(F.col("text")).alias("w"), F.size(words(F.col("text"))).alias("n")).where("n > 0")
    parts = []
    for size in range(1, span + 1):
        rows = w.where(F.col("n") >= span if size == span else F.col("n") == size)
        k = min(gram, size)
        m = rows.select("item_id", "w", let(grams(F.col("w"), k), lambda g: minima(F.col("w"), g, size, k)).alias("m"))  # noqa: B023
        at = m.select("item_id", "w", F.posexplode("m").alias("i", "f"))
        parts.append(at.select(F.lit(size).alias("span"), "f", F.concat_ws(" ", F.slice("w", F.col("i") + 1, size)).alias("window"), "item_id"))
    return reduce(DataFrame.unionByName, parts).distinct()


def hits(docs: DataFrame, windows: DataFrame, span: int = SPAN, gram: int = GRAM, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, text_key, span, pos, items): where in each document, from word 1, a benchmark window stands.

    One pass over the texts serves all lengths of windows.
    """
    keyed = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    few = windows.limit(broadcast_windows + 1).count() <= broadcast_windows
    send = F.broadcast if few else (lambda df: df)
    named = windows.groupBy("span", "window").agg(F.collect_set("item_id").alias("items"))
    sizes = sorted(r[0] for r in windows.select("span").distinct().collect())  # at most `span` values
    if not sizes:
        none = keyed.where(F.lit(False)).select("doc_id", "text_key", F.lit(0).alias("span"), F.lit(0).alias("pos"))
        return none.crossJoin(F.broadcast(named.select("items").limit(0)))
    prints = windows.select("f", "span", F.array_position(F.array(*map(F.lit, sizes)), F.col("span")).cast("int").alias("nth")).distinct()
    cut = keyed.select("doc_id", "text_key", words(F.col("text")).alias("w"))

    def of(k: int) -> Column:  # by let(): a column of grams would be worked out anew for every window
        mine = [size for size in sizes if min(gram, size) == k]
        return let(grams(F.col("w"), k), lambda g: F.array(*(minima(F.col("w"), g, size, k) for size in mine)))

    of_sizes = [of(k) for k in sorted({min(gram, size) for size in sizes})]  # in order of the sizes
    prepared = cut.select("doc_id", "text_key", "w", (F.concat(*of_sizes) if len(of_sizes) > 1 else of_sizes[0]).alias("m"))
    each = F.array_distinct(F.flatten("m") if len(sizes) > 1 else F.col("m")[0])
    if few:
        found = prepared.select("doc_id", "text_key", "w", "m", F.explode(each).alias("f")).join(F.broadcast(prints), "f")
    else:  # only fingerprints are shuffled, and then the texts of documents with one
        which = prepared.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.explode(each).alias("f")).join(prints, "f").distinct()
        found = prepared.dropDuplicates(["doc_id", "text_key"]).join(which, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    at = found.select("doc_id", "text_key", "w", "span", F.explode(let(F.element_at("m", F.col("nth")), lambda y: F.filter(F.sequence(F.lit(1), F.size(y)), lambda i: F.element_at(y, i) == F.col("f")))).alias("pos"))
    at = at.select("doc_id", "text_key", "span", "pos", F.concat_ws(" ", F.slice("w", F.col("pos"), F.col("span"))).alias("window"))
    return at.join(send(named), ["span", "window"]).select("doc_id", "text_key", "span", "pos", "items")


def _covered(spans: Column) -> Column:
    """Words in the union of sorted (pos, span) intervals."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(acc, x):
        end = (x["pos"] + x["span"]).cast("long")
        return F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["end"], x["pos"].cast("long")))).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(spans, start, add)["n"]


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, items (sorted array of item_ids as strings), contaminated."""
    windows = written(benchmark_windows(items.select("item_id", "text"), span, gram), "windows")
    found = hits(docs.select("doc_id", "text"), windows, span, gram)
    by_doc = found.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("pos", "span"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("ids"),
    )
    by_doc = by_doc.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), _covered(F.col("spans")).alias("n_hit"), F.array_sort(F.transform("ids", lambda x: x.cast("string"))).alias("items"))
    all_docs = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    out = all_docs.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "text_key", "n_words", hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (hit > 0).alias("contaminated"))


def sent_if_small(found: DataFrame) -> DataFrame:
    """found as a table of the shared folder, marked for broadcast if it has few rows."""
    return small(written(found, "contaminated"))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's columns of contamination()."""
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


DIGEST_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win FROM bi),
ks AS (SELECT DISTINCT k FROM bw),
di AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k),
h AS (SELECT di.doc_id, di.i, di.k, bw.item_id FROM di JOIN bw ON bw.k = di.k AND bw.win = array_to_string(list_slice(di.w, di.i, di.i + di.k - 1), ' ')),
p AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS q FROM (SELECT DISTINCT doc_id, i, k FROM h)) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
