"""Near duplicates by banded MinHash whose candidates are verified by odd sketches.

A set's MinHash samples serve twice. Bands of them bring similar sets together: sets that
agree in a whole band are candidates. And all samples are folded into a parity bitmap, the
odd sketch: each sample flips the bit that its place and value hash to. In the XOR of two
sketches equal samples cancel, so its population count tells how many samples differ, at
high similarities more precisely than a sample of as many bits does. Candidates whose
sketches are too far apart for the threshold are dropped, the others compared on full sets.

Which sets end up together matters, not every link. So each band's members are first
compared to one member of it, each set with the nearest such member only, and again with
another one. What these connect needs no more comparisons; what is left of a band, sets not
connected yet, meets in a join under the sketches' bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.bytewords import STEP, U, mix
from tidemark.llm.jaccard import components, sets_of
from tidemark.llm.store import Scratch, map_arrow

SAMPLES = 2040
BANDED = 255  # of them, those that make up bands
WORDS = 64  # of 64 bits, per sketch
SKETCH = [f"odd_{i}" for i in range(WORDS)]
MISS = 1e-8  # of a link right at the threshold, by its bands
DEVIATIONS = 6  # of the bits in which linked sketches differ
BROADCAST_KEYS = 1_000_000
ELEMENTS = 1 << 16  # hashed at once


class Plan(NamedTuple):
    """Samples per band, bands, and the most bits in which sketches of linked sets differ."""

    rows: int
    bands: int
    reach: int


def plan(percent: int, samples: int = SAMPLES, banded: int = BANDED) -> Plan:
    """The widest bands that miss a link at the threshold no more often than ``MISS``, and the
    reach of sketches that are linked."""
    alike = percent / 100
    fits = [r for r in range(1, banded + 1) if (1 - alike**r) ** (banded // r) <= MISS]
    rows = max(fits, default=1)
    bits = 64 * WORDS
    # Each differing sample flips a bit of either sketch. One bit of the XOR stays as it was
    # in ``one``, two of them differ from that together in ``two``.
    flips = 2 * samples * (1 - alike)
    one, two = (1 - 2 / bits) ** flips, (1 - 4 / bits) ** flips
    of_places = (bits + bits * (bits - 1) * two - (bits * one) ** 2) / 4
    of_samples = one**2 * 4 * samples * alike * (1 - alike)
    return Plan(rows, banded // rows, min(bits, math.ceil(bits * (1 - one) / 2 + DEVIATIONS * math.sqrt(of_places + of_samples))))


def multipliers(samples: int) -> np.ndarray:
    return mix(np.arange(1, samples + 1, dtype=U) * STEP) | U(1)


def min_hashes(values: np.ndarray, starts: np.ndarray, samples: int) -> np.ndarray:
    """(samples x sets) least values of the sets that begin at ``starts`` under as many
    orders."""
    out = np.empty((samples, len(starts)), dtype=U)
    product = np.empty_like(values)
    for i, factor in enumerate(multipliers(samples)):
        out[i] = np.minimum.reduceat(np.multiply(values, factor, out=product), starts)
    return out


def odd_sketches(least: np.ndarray) -> np.ndarray:
    """(sets x WORDS) parities of the places that the samples hash to."""
    samples, sets = least.shape
    bits = 64 * WORDS
    place = mix(least + np.arange(1, samples + 1, dtype=U)[:, None] * STEP) % U(bits)
    flips = np.bincount((place.astype(np.int64) + np.arange(sets) * bits).ravel(), minlength=sets * bits)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.int64).reshape(sets, WORDS)


def bands_of(least: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """(sets x bands) names of the buckets that the sets fall into."""
    out = np.empty((least.shape[1], bands), dtype=np.int64)
    for band in range(bands):
        value = np.full(least.shape[1], U(band + 1))
        for sample in least[band * rows : (band + 1) * rows]:
            value = mix(value * STEP + sample)
        out[:, band] = value.view(np.int64)
    return out


def _described(keyed: DataFrame, k: int, how: Plan, samples: int) -> DataFrame:
    """Per text its set's size, name of 128 bits, sketch and buckets."""
    import xxhash

    def described(values: list[np.ndarray]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        names = [xxhash.xxh3_128_digest(v.tobytes()) for v in values]
        least = min_hashes(np.concatenate(values), np.cumsum([0, *map(len, values[:-1])]), samples)
        return names, odd_sketches(least), bands_of(least, how.rows, how.bands)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = len(batch)
            sizes = np.zeros(rows, dtype=np.int64)
            names: list[bytes | None] = [None] * rows
            odd, buckets = np.zeros((rows, WORDS), np.int64), np.zeros((rows, how.bands), np.int64)
            held: list[tuple[int, np.ndarray]] = []

            def flush() -> None:
                if held:
                    at = [row for row, _ in held]
                    found, odd[at], buckets[at] = described([v for _, v in held])
                    for row, name in zip(at, found):
                        names[row] = name
                    held.clear()

            elements = 0
            for row, values in sets_of(batch.column(3), k):
                sizes[row] = len(values)
                if len(values):
                    held.append((row, values))
                    elements += len(values)
                    if elements > ELEMENTS:
                        flush()
                        elements = 0
            flush()
            counts = np.where(sizes > 0, how.bands, 0)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(buckets[sizes > 0].ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes), pa.array(names, pa.binary()), *[pa.array(odd[:, i]) for i in range(WORDS)], lists],
                                             names=["key_1", "key_2", "doc_id", "n", "sig", *SKETCH, "buckets"])

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return map_arrow(keyed, run, f"key_1 long, key_2 long, doc_id {kind}, n long, sig binary, {' long, '.join(SKETCH)} long, buckets array<long>")


def apart(x: str, y: str) -> Column:
    """Bits in which two sketches differ."""
    bits = [F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))) for w in SKETCH]
    return sum(bits[1:], bits[0])


def _possible(x: str, y: str, percent: int, how: Plan) -> Column:
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (apart(x, y) <= how.reach)


def _links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for (_, x), (_, y) in zip(sets_of(batch.column(2), k), sets_of(batch.column(3), k)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(both, compare, "a long, b long")


def near_classes(docs: DataFrame, k: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text", samples: int = SAMPLES, stars: int = 2) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id`` (least id that links
    reach), ``kept`` (the row has that id).

    Sets of k-word shingles (A-Z lower-cased) link if their Jaccard index is at least
    ``percent`` hundredths, computed on full sets. Texts with fewer words than k are one shingle;
    null texts and those without words have none, link with nothing and are kept. A link right
    at the threshold is no candidate once in 10**8 times, those above it far less often.
    Rows with a null id take part; they count for no least id, and are null among themselves. Repeated
    rows fall in one component and agree in ``kept``. Other columns are not read, whatever
    their names; an empty table gives an empty result. ``stars``: rounds of
    comparisons with one member of each band; it bears on cost, not on results.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    how = plan(percent, samples)
    key = [F.xxhash64(id_column, text_column).alias("key_1"), F.xxhash64(F.lit(1), text_column, id_column).alias("key_2")]
    keyed = docs.select(*key, F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    first = scratch.write(_described(keyed, k, how, samples), "odd-first")
    # One row per distinct set, numbered; the numbers hold as the table is written.
    one = [F.min("doc_id").alias("least_id"), F.min(F.struct("key_1", "key_2")).alias("key"), F.max("n").alias("n"), F.max("buckets").alias("buckets"), *[F.max(w).alias(w) for w in SKETCH]]
    sets = scratch.write(first.where("n > 0").groupBy("sig").agg(*one).withColumn("set", F.monotonically_increasing_id()), "odd-sets")
    links = _all_links(scratch, sets, keyed, k, percent, how, stars)
    labels = scratch.write(components(links), "odd-labels")
    named = sets.select("sig", "set", "least_id").join(labels.withColumnRenamed("sig", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_sig = scratch.write(named.join(least, "component").select(F.col("sig").alias("own"), F.lit(True).alias("named"), "component_id"), "odd-components")
    rows = first.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(by_sig, F.col("sig") == F.col("own"), "left")
    rows = rows.withColumn("component_id", F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id")))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _texts_of(scratch: Scratch, members: DataFrame, sets: DataFrame, keyed: DataFrame) -> DataFrame:
    """(set, text) of the sets named."""
    keys = scratch.write(members.join(sets, "set").select("key.*", "set"), "odd-keys")
    # A key has 24 bytes. Beyond the bound, the join shuffles the texts instead.
    side = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    # Rows repeated with id and text have one key.
    texts = scratch.write(keyed.join(side, ["key_1", "key_2"]).dropDuplicates(["set"]).select("set", "text"), "odd-texts")
    scratch.drop(keys)
    return texts


def _all_links(scratch: Scratch, sets: DataFrame, keyed: DataFrame, k: int, percent: int, how: Plan, stars: int) -> DataFrame:
    """Links (a, b) enough to connect all sets that links connect."""
    sketch = sets.select("set", "n", *SKETCH)
    members = sets.select("set", F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("set").alias("low"), F.max("set").alias("high")).where("low < high").select("bucket")
    own = scratch.write(members.join(shared, "bucket"), "odd-buckets")
    # How often a set meets others. In a family, the one that the others were made from meets
    # most of them and is the best to compare with.
    sizes = own.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    meets = own.join(sizes, "bucket").groupBy("set").agg(F.sum("size").alias("meets"))
    texts = _texts_of(scratch, own.select("set").distinct(), sets, keyed)
    state, links, tried = own.join(meets, "set").withColumn("component", F.col("set")), None, None

    def verified(pairs: DataFrame) -> DataFrame:
        """All links found so far, with those of the pairs."""
        nonlocal tried
        now = scratch.write(pairs.select("a", "b"), "odd-pairs")
        found = scratch.write(_links(now, texts, k, percent), "odd-links")
        tried = now if tried is None else tried.union(now)
        return found if links is None else links.union(found)

    def open_state() -> DataFrame:
        """Bucket members with their component, of buckets that hold more than one."""
        labels = components(links).withColumnRenamed("sig", "set")
        marked = own.join(labels, "set", "left").withColumn("component", F.coalesce("component", "set"))
        still = marked.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
        return scratch.write(marked.join(still, "bucket"), "odd-open")

    for turn in range(stars):
        order = F.xxhash64("component", F.lit(turn)) if turn else F.struct(-F.col("meets"), "set")
        head = F.min_by(F.struct(F.col("set").alias("head"), F.col("component").alias("other")), order)
        heads = state.groupBy("bucket").agg(head.alias("h")).select("bucket", "h.*")
        pairs = state.join(heads, "bucket").where("component <> other").select("set", "head").distinct()
        x, y = sketch.alias("x"), sketch.alias("y")
        near = pairs.alias("p").join(x, F.col("p.set") == F.col("x.set")).join(y, (F.col("p.head") == F.col("y.set")) & _possible("x", "y", percent, how)).select(
            F.col("p.set").alias("set"), F.struct(apart("x", "y").alias("apart"), F.col("p.head").alias("head")).alias("to"))
        nearest = near.groupBy("set").agg(F.min("to.apart").alias("apart"), F.min("to").alias("to"))
        pairs = nearest.select(F.greatest("set", "to.head").alias("a"), F.least("set", "to.head").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        links = verified(pairs)
        last, state = state, open_state()
        if turn:
            scratch.drop(last)
    if not stars:
        state = scratch.write(state, "odd-open")
    # What is left of the buckets meets under the bounds, not pair by pair.
    # Of the buckets that two sets share, the least one names the pair.
    marked = scratch.write(state.join(sets.select("set", "n", "buckets", *SKETCH), "set"), "odd-left")
    x, y = marked.alias("x"), marked.alias("y")
    named = F.col("x.bucket") == F.array_min(F.array_intersect("x.buckets", "y.buckets"))
    met = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.set") > F.col("y.set")) & (F.col("x.component") != F.col("y.component")) & _possible("x", "y", percent, how) & named)
    pairs = met.select(F.col("x.set").alias("a"), F.col("y.set").alias("b"), apart("x", "y").alias("apart"), F.col("x.component").alias("of_a"), F.col("y.component").alias("of_b"))
    if tried is not None:
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
    pairs = scratch.write(pairs, "odd-met")
    scratch.drop(marked, state)
    # First the nearest pair of each two components; the rest only if that is no link.
    first = scratch.write(pairs.groupBy("of_a", "of_b").agg(F.min(F.struct("apart", "a", "b")).alias("p")).select("p.a", "p.b"), "odd-nearest")
    links = verified(first)
    labels = components(links)
    rest = pairs.join(first, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        rest = rest.join(labels.select(F.col("sig").alias(end), F.col("component").alias(f"now_{end}")), end, "left")
    return verified(rest.where(F.coalesce("now_a", "a") != F.coalesce("now_b", "b")))
