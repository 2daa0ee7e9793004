"""Near-duplicate records with small edits (problem 1).

1. Rows become sorted word lists; rows with the same words form a text class, and
   only one representative of a class goes on, so exact and formatting copies cost
   nothing further however many there are.
2. Each class is sketched as the set of its (word, occurrence), every one alike, so
   that the similarity sought is the one required whatever words were edited.
3. Bands of the sketch join classes that may be alike. The number of words and a
   signature of 512 bits travel with each band and bound the common words from
   above, so pairs that can't agree are dropped before any text is fetched, and no other.
4. Classes of hot bands (a template that many texts share) are joined by their rarest
   words instead, where that makes fewer pairs: texts that agree share one of them.
5. The agreement of what remains is computed exactly from the words.

Only banding is probabilistic: with the defaults a pair at agreement 0.75 (Jaccard 0.6)
is found with a probability of about 0.999 and one at 0.8 with over 0.9999, whatever its words.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curlew.llm import sketch as S
from curlew.llm.tokenizer import small_batches
from curlew.session import materialize

WORDS = regex.compile(r"[\p{L}\p{N}]+")
SIGNATURE = tuple(f"s{i}" for i in range(8))
#: Texts sketched together; it bounds a worker's memory and changes no result.
SKETCH_BATCH = 500


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits in lower case."""
    return WORDS.findall(text.lower()) if text else []


def agreement(a: list[str], b: list[str]) -> float:
    """Common words, with repeats, over the words of the longer record; 0 where neither has any."""
    longer = max(len(a), len(b))
    return (Counter(a) & Counter(b)).total() / longer if longer else 0.0


def text_classes(rows: DataFrame, key: str, title: str, description: str, min_words: int) -> tuple[DataFrame, DataFrame]:
    """(members: text_key, copy, key) and (classes: id, text_key, rep, n, words), both written to the shared folder."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, digests, copies = [], [], [], []
            for k, t, d in zip(*(c.to_pylist() for c in batch.columns)):
                body = words_of(d)
                if len(body) >= min_words:
                    text = " ".join(sorted(words_of(t) + body))
                    keys.append(k), texts.append(text), digests.append(hashlib.md5(text.encode()).digest()), copies.append(hashlib.md5(repr((t, d)).encode()).digest())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.binary()), pa.array(texts, pa.string()), pa.array(copies, pa.binary())], names=["key", "text_key", "words", "copy"])

    columns = [F.col(c).cast("string") for c in (key, title, description)]
    texts = rows.where(F.col(key).isNotNull() & F.col(description).isNotNull()).select(*columns).mapInArrow(run, "key string, text_key binary, words string, copy binary")
    texts = materialize(texts, "texts")
    classes = texts.groupBy("text_key").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("words").alias("words"))
    return texts.select("text_key", "copy", "key"), materialize(classes.select(F.monotonically_increasing_id().alias("id"), "text_key", "rep", "n", "words"), "classes")


def word_weights(classes: DataFrame, max_weight: int) -> dict[str, int]:
    """The weight of each word that is in more than one of 2**max_weight documents; all others weigh ``max_weight``.

    A word in a share s of all documents weighs -log2(s), rounded down, and 1 at
    least. The number of words returned is at most the mean number of words of a
    document times 2**max_weight, whatever the number of documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for words, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[""] += n
                for w in set(words.split(" ")):
                    counts[w] += n
            if len(counts) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
                counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    total = classes.agg(F.sum("n")).first()[0] or 0
    frequent = classes.select("words", "n").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where((F.col("word") != "") & (F.col("n") * (1 << max_weight) > total))
    return {w: min(max_weight, max(1, int(np.log2(total / n)))) for w, n in frequent.collect()}


def signed(classes: DataFrame, keys: Callable[[list[str], np.ndarray, np.ndarray, list[int]], pa.ListArray], name: str) -> DataFrame:
    """(id, size, s0..s7, keys): number of words, signature, and what ``keys`` makes of (words, hashed elements, owner, sizes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, SKETCH_BATCH):
                part = batch.slice(start, SKETCH_BATCH)
                split = [w.split(" ") for w in part.column(1).to_pylist()]
                for w in set().union(*split).difference(known):
                    known[w] = xxhash.xxh3_64_intdigest(w)
                flat, sizes = [w for words in split for w in words], [len(words) for words in split]
                owner, hashes = np.repeat(np.arange(len(split)), sizes), np.array([known[w] for w in flat], np.uint64)
                if len(known) > 500_000:
                    known.clear()
                # Sorted words: the place in a run of equal ones is the occurrence.
                place = np.arange(len(hashes))
                first = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]
                occurrence = (place - np.maximum.accumulate(np.where(first, place, 0))).astype(np.uint64)
                elements = S.mix(hashes + occurrence * S._B)
                bits = S.signature(elements, owner, len(split), 64 * len(SIGNATURE))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int32()), *(pa.array(bits[:, i]) for i in range(len(SIGNATURE))), keys(flat, elements, owner, sizes)], names=["id", "size", *SIGNATURE, "keys"])

    return materialize(classes.select("id", "words").mapInArrow(run, f"id long, size int, {', '.join(f'{c} long' for c in SIGNATURE)}, keys array<long>"), name)


def sketches(classes: DataFrame, bands: int, band_rows: int) -> DataFrame:
    """The band keys of each class, and its signature."""

    def keys(_flat: list[str], elements: np.ndarray, owner: np.ndarray, sizes: list[int]) -> pa.ListArray:
        made = S.band_keys(S.sketch(elements, owner, len(sizes), bands * band_rows), bands, band_rows)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, made.size + 1, bands, dtype=np.int32)), pa.array(made.ravel()))

    return signed(classes, keys, "sketches")


def prefixes(classes: DataFrame, weights: dict[str, int], max_weight: int, least: float) -> DataFrame:
    """The rarest (word, occurrence) of each class, and its signature: of n words so many that texts that agree to ``least`` share one."""
    shared = classes.sparkSession.sparkContext.broadcast(weights)

    def keys(flat: list[str], elements: np.ndarray, owner: np.ndarray, sizes: list[int]) -> pa.ListArray:
        common = np.array([-shared.value.get(w, max_weight) for w in flat])
        order = np.lexsort((elements, common, owner))
        taken = [n - needed(n, least) + 1 for n in sizes]
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        made = elements[order][place < np.repeat(taken, sizes)].astype(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(taken)].astype(np.int32)), pa.array(made))

    return signed(classes, keys, "prefixes")


def needed(size: int, least: float) -> int:
    """Words that a text of ``size`` words has in common with any that agrees to ``least`` (rounding errors aside)."""
    return max(1, math.ceil(size * least - 1e-9))


def key_counts(keyed: DataFrame, over: int) -> DataFrame:
    """(key, n) of the keys that more than ``over`` rows share."""
    return materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > over), "key-counts")


def joined(keyed: DataFrame, counts: DataFrame, least: float, block: int) -> DataFrame:
    """(a, b): ids that share a key (id, size, s0..s7, key), without pairs whose sizes or signatures rule agreement out.

    A bit that only one of the two has stands for at least one word of its own. Keys
    of over ``block`` rows are cut into blocks of about that many, by size and at
    random, and each pair of blocks whose sizes allow agreement is a join key of its
    own, so the pairs of one key are shared out over all tasks.
    """
    step = math.log(1 / least) + 1e-6  # sizes that allow agreement lie in the same or in neighbouring classes
    big = counts.where(F.col("n") > block).select("key")
    parts = keyed.join(big, "key", "left_semi").withColumn("z", F.floor(F.log(F.greatest(F.lit(1), F.col("size"))) / step).cast("int"))
    sizes = parts.groupBy("key", "z").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("salts"))
    large = materialize(sizes.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("z", "salts"))).alias("salts")), "large-keys")  # an entry for each size class

    cut = parts.join(large, "key").withColumn("t", F.pmod(F.xxhash64("id"), F.element_at("salts", F.col("z"))).cast("int"))
    cell = lambda *x: F.struct(*[c.cast("int").alias(n) for c, n in zip(x, ("z0", "t0", "z1", "t1"))])
    salts = lambda z: F.sequence(F.lit(0), F.try_element_at("salts", z) - 1)
    none = F.array().cast("array<struct<z0:int,t0:int,z1:int,t1:int>>")
    z, t = F.col("z"), F.col("t")
    above = F.concat(F.transform(F.filter(salts(z), lambda u: u >= t), lambda u: cell(z, t, z, u)), F.coalesce(F.transform(salts(z + 1), lambda u: cell(z, t, z + 1, u)), none))
    below = F.concat(F.transform(F.filter(salts(z), lambda u: u <= t), lambda u: cell(z, u, z, t)), F.coalesce(F.transform(salts(z - 1), lambda u: cell(z - 1, u, z, t)), none))
    whole = keyed.join(big, "key", "left_anti")
    side = lambda df, n, *keys: df.select(*keys, *[F.col(c).alias(f"{c}_{n}") for c in ("id", "size", *SIGNATURE)])
    common = F.ceil(F.greatest("size_a", "size_b") * F.lit(least) - F.lit(1e-9))
    own = lambda x, y: sum(F.bit_count(F.col(f"{c}_{x}").bitwiseAND(F.bitwise_not(F.col(f"{c}_{y}")))) for c in SIGNATURE)
    may = (F.least("size_a", "size_b") >= common) & (own("a", "b") <= F.col("size_a") - common) & (own("b", "a") <= F.col("size_b") - common)
    same = (F.col("cell.z0") == F.col("cell.z1")) & (F.col("cell.t0") == F.col("cell.t1"))
    small = side(whole, "a", "key").join(side(whole, "b", "key"), "key").where((F.col("id_a") < F.col("id_b")) & may)
    halves = [side(cut.withColumn("cell", F.explode(cells)), n, "key", "cell") for n, cells in (("a", above), ("b", below))]
    split = halves[0].join(halves[1], ["key", "cell"]).where((~same | (F.col("id_a") < F.col("id_b"))) & may)
    ends = [F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")]
    return small.select(*ends).unionByName(split.select(*ends))


def candidates(made: DataFrame, classes: DataFrame, least: float, max_weight: int, hot: int, block: int) -> DataFrame:
    """(a, b): ids that share a band and may agree; bands of over ``hot`` classes are replaced by the rarest words of these classes if that makes fewer pairs."""
    keyed = lambda df: df.select("id", "size", *SIGNATURE, F.explode("keys").alias("key"))
    bands = keyed(made)
    pairs_of = lambda df: df.where(F.col("n") > hot).agg(F.sum(F.col("n") * (F.col("n") - 1.0))).first()[0] or 0
    counts = key_counts(bands, min(hot, block))
    if not (most := pairs_of(counts)):
        return joined(bands, counts, least, block).distinct()
    large = counts.where(F.col("n") > hot).select("key")
    some = materialize(classes.join(bands.join(large, "key", "left_semi").select("id").distinct(), "id", "left_semi"), "some")
    rarest = keyed(prefixes(some, word_weights(some, max_weight), max_weight, least))
    rare_counts = key_counts(rarest, 1)
    if (rare_counts.agg(F.sum(F.col("n") * (F.col("n") - 1.0))).first()[0] or 0) >= most:
        return joined(bands, counts, least, block).distinct()
    return joined(bands.join(large, "key", "left_anti"), counts, least, block).unionByName(joined(rarest, rare_counts, least, block)).distinct()


def verified(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(a, b, agreement) of the pairs whose words agree to at least ``least``."""
    words = lambda n: classes.select(F.col("id").alias(n), F.col("words").alias(f"words_{n}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, wa, wb = (c.to_pylist() for c in batch.columns)
            share = [agreement(x.split(" "), y.split(" ")) for x, y in zip(wa, wb)]
            hit = pa.array([s >= least for s in share], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share, pa.float64())], names=["a", "b", "agreement"]).filter(hit)

    return pairs.join(words("a"), "a").join(words("b"), "b").select("a", "b", "words_a", "words_b").mapInArrow(run, "a long, b long, agreement double")


class Linked(NamedTuple):
    """members (text_key, copy, key), classes (id, text_key, rep, n, words) and links (a, b, agreement) between ids of classes."""

    members: DataFrame
    classes: DataFrame
    links: DataFrame


def linked(rows: DataFrame, key: str, title: str, description: str, min_words: int, least: float, bands: int, band_rows: int, max_weight: int, hot: int, block: int) -> Linked:
    members, classes = text_classes(rows, key, title, description, min_words)
    near = candidates(sketches(classes, bands, band_rows), classes, least, max_weight, hot, block)
    return Linked(members, classes, materialize(verified(materialize(near, "candidates"), classes, least), "found"))


def belonging(members: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """(key, class_key, copies) of each record that takes part."""
    each = members.select("text_key", "key").distinct().join(classes.select("text_key", F.col("rep").alias("class_key")), "text_key")
    sizes = each.groupBy("class_key").agg(F.count(F.lit(1)).alias("copies"))
    return each.join(sizes, "class_key").select(F.col("key").alias(key), "class_key", "copies")


def record_classes(rows: DataFrame, key: str = "project_uid", title: str = "title", description: str = "description", min_words: int = 30) -> DataFrame:
    """The membership of ``near_duplicate_classes`` by itself, without a search for links."""
    return belonging(*text_classes(rows, key, title, description, min_words), key)


def near_duplicate_classes(
    rows: DataFrame,
    key: str = "project_uid",
    title: str = "title",
    description: str = "description",
    min_words: int = 30,
    least: float = 0.75,
    bands: int = 50,
    band_rows: int = 4,
    max_weight: int = 10,
    hot: int = 10_000,
    block: int = 2000,
) -> tuple[DataFrame, DataFrame]:
    """((key, class_key, copies), (class_key_a, class_key_b, agreement)): membership, and every link between classes.

    A class are the records of equal words; its key is its smallest record. The form
    is the same at any size: a class that a third of all records share is as many
    membership rows, and one row for each of its links. Records that take no part
    (see ``near_duplicates``) have no class.
    """
    members, classes, links = linked(rows, key, title, description, min_words, least, bands, band_rows, max_weight, hot, block)
    names = lambda n: classes.select(F.col("id").alias(n), F.col("rep").alias(f"class_key_{n}"))
    named = links.join(names("a"), "a").join(names("b"), "b").select(F.least("class_key_a", "class_key_b").alias("class_key_a"), F.greatest("class_key_a", "class_key_b").alias("class_key_b"), "agreement")
    return belonging(members, classes, key), named


def near_duplicates(
    rows: DataFrame,
    key: str = "project_uid",
    title: str = "title",
    description: str = "description",
    min_words: int = 30,
    least: float = 0.75,
    bands: int = 50,
    band_rows: int = 4,
    max_weight: int = 10,
    hot: int = 10_000,
    block: int = 2000,
    expand: int = 1000,
) -> DataFrame:
    """(key_a, key_b): every pair of records that agree, the smaller key first.

    Records with a null key or description, or fewer than ``min_words`` words in
    the description, are in no pair; a null title has no words. Rows that repeat a
    key count once. Members of a class of equal words are paired with each other and
    with the members of classes that agree with theirs; in a class of over
    ``expand`` members, whose pairs would be quadratic, rows of identical title and
    description are linked as a star from their smallest key, which stands for them
    in links to all other texts, those of the class included. ``near_duplicate_classes``
    has the same links in one form at any size.
    """
    members, classes, links = linked(rows, key, title, description, min_words, least, bands, band_rows, max_weight, hot, block)
    found = links.select("a", "b")
    sizes = classes.select("id", "text_key", "rep", "n")
    large = members.join(sizes.where(F.col("n") > expand).select("text_key", "id"), "text_key")
    stars = materialize(large.groupBy("id", "text_key", "copy").agg(F.min("key").alias("rep")), "stars")
    listed = materialize(
        members.join(sizes.where((F.col("n") > 1) & (F.col("n") <= expand)).select("text_key", "id"), "text_key").select("id", "key")
        .unionByName(sizes.where(F.col("n") == 1).select("id", F.col("rep").alias("key")))
        .unionByName(stars.select("id", F.col("rep").alias("key"))),
        "listed",
    )
    side = lambda n: listed.select(F.col("id").alias(n), F.col("key").alias(f"key_{n}"))
    between = found.join(side("a"), "a").join(side("b"), "b").select("key_a", "key_b")
    several = listed.join(sizes.where(F.col("n") > 1).select("id"), "id", "left_semi")
    within = several.select("id", F.col("key").alias("key_a")).join(several.select("id", F.col("key").alias("key_b")), "id").where("key_a < key_b").select("key_a", "key_b")
    star = members.join(stars.select("text_key", "copy", "rep"), ["text_key", "copy"]).select(F.col("rep").alias("key_a"), F.col("key").alias("key_b"))
    pairs = between.unionByName(within).unionByName(star).where("key_a <> key_b")
    return pairs.select(F.least("key_a", "key_b").alias(f"{key}_a"), F.greatest("key_a", "key_b").alias(f"{key}_b")).distinct()
