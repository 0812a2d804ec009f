"""Set similarity join on word n-grams as a blocked sparse matrix product, and the classes
of documents that its links connect.

The incidence matrix has a row per distinct set and a column per n-gram. Shuffled by n-gram,
its columns form blocks; a block's share of the product is the number of n-grams that two
sets have in common there, and the shares are summed per pair. Bounds that follow from the
sizes alone keep the product small and lose no link:

* sizes of linked sets differ by the threshold at most;
* in an order common to all sets (rarest first), the first n-gram that linked sets share has
  a place near the front of each, so only short prefixes are multiplied, the smaller set's
  about half as long as the larger one's;
* linked sets differ in few n-grams, and the parity of a set's hashes in 512 slots differs in
  no more slots than the sets do in n-grams; pairs further apart get no row;
* the n-grams met so far and those left behind the last one must suffice for the threshold.

What passes is bounded once more, by tallies of all hashes in slots, and then compared exactly.
Equal sets are one row. Families of near copies are joined to one member first; only pairs of
sets that are not yet connected are multiplied afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.bytewords import U, shingles_of, text_slices, words_of
from tidemark.llm.store import Scratch, map_arrow, ship, written

CELLS_LOG = 20
CHUNK = 1 << 12  # cells per row of partial counts
PARITIES = 8  # words of 64 bits
BITS = [f"bits_{i}" for i in range(PARITIES)]
BROADCAST_KEYS = 1_000_000


def least_common(n: np.ndarray, percent: int) -> np.ndarray:
    """Common n-grams that a linked partner of a set of size n must have: at least this."""
    return -(-n * percent // 100)


def sets_of(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for row, data, offsets in text_slices(column):
        shingles = shingles_of(words_of(data, offsets), k)
        cuts = np.searchsorted(shingles.doc, np.arange(len(offsets)))
        for i in range(len(offsets) - 1):
            yield row + i, np.unique(shingles.hash[cuts[i] : cuts[i + 1]])


def signature(values: np.ndarray) -> int:
    """64-bit name of a set of hashes."""
    import xxhash

    return xxhash.xxh3_64_intdigest(values.tobytes()) - (1 << 63)


def parities(values: np.ndarray) -> np.ndarray:
    """Per slot of hashes whether a set has an odd number of them, as PARITIES words."""
    slots = (values & U(64 * PARITIES - 1)).astype(np.int64)
    return np.packbits((np.bincount(slots, minlength=64 * PARITIES) & 1).astype(np.uint8)).view(np.int64)


def tallies(values: np.ndarray) -> np.ndarray:
    """How many hashes of a set fall in each slot, modulo 256. A slot takes up to four on
    average, so longer sets have more slots, and no length is too long to tell sets apart."""
    slots = 1 << max(8, (max(len(values), 1) // 4).bit_length())
    return np.bincount((values & U(slots - 1)).astype(np.int64), minlength=slots).astype(np.uint8)


def tallies_apart(x: np.ndarray, y: np.ndarray) -> int:
    """At most as much as the number of hashes that only one of two sets has."""
    if len(x) > len(y):
        x, y = y, x
    gap = x - y.reshape(-1, len(x)).sum(axis=0, dtype=np.uint8)
    return int(np.minimum(gap, -gap).sum(dtype=np.int64))


def _batch(columns: list, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _first_pass(keyed: DataFrame, k: int) -> DataFrame:
    """Per text its set's size, name and parities, and per task the counts of hash cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELLS_LOG, dtype=np.int32)
        names = ["row_key", "doc_id", "n", "sig", *BITS, "chunk", "counts"]
        for batch in batches:
            sizes, sigs = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            bits = np.zeros((PARITIES, len(batch)), np.int64)
            for row, values in sets_of(batch.column(2), k):
                sizes[row] = len(values)
                if len(values):
                    sigs[row], bits[:, row] = signature(values), parities(values)
                    np.add.at(cells, (values >> U(64 - CELLS_LOG)).astype(np.int64), 1)
            nothing = [None] * len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes), pa.array(sigs), *map(pa.array, bits), pa.array(nothing, pa.int32()), pa.array(nothing, pa.binary())], names=names)
        used = [c for c in range(len(cells) // CHUNK) if cells[c * CHUNK : (c + 1) * CHUNK].any()]
        nothing = [None] * len(used)
        yield _batch([*[nothing] * (4 + PARITIES), used, [cells[c * CHUNK : (c + 1) * CHUNK].tobytes() for c in used]], names,
                     [pa.int64(), keyed_type, *[pa.int64()] * (2 + PARITIES), pa.int32(), pa.binary()])

    from pyspark.sql.pandas.types import to_arrow_type

    keyed_type = to_arrow_type(keyed.schema["doc_id"].dataType)
    kind = keyed.schema["doc_id"].dataType.simpleString()
    return map_arrow(keyed, run, f"row_key long, doc_id {kind}, n long, sig long, {' long, '.join(BITS)} long, chunk int, counts binary")


def _cell_counts(first: DataFrame) -> np.ndarray:
    """The summed counts: 4 MB, whatever the input."""

    def added(chunk, parts):
        import pandas as pd

        total = np.zeros(CHUNK, dtype=np.int64)
        for part in parts["counts"]:
            total += np.frombuffer(part, dtype=np.int32)
        return pd.DataFrame({"chunk": [chunk[0]], "counts": [np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()]})

    ship(first.sparkSession)
    rows = first.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInPandas(added, "chunk int, counts binary").collect()
    cells = np.zeros(1 << CELLS_LOG, dtype=np.int32)
    for row in rows:
        cells[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], dtype=np.int32)
    return cells


def _prefixes(keyed: DataFrame, k: int, percent: int, cells: np.ndarray) -> DataFrame:
    """Incidences (gram, sig, n, place) in the prefixes. The order is by the count of the
    gram's cell, then its hash: any order common to all sets gives the same links, this one
    puts grams first that few sets share."""
    shared = keyed.sparkSession.sparkContext.broadcast(cells)

    def whole(*parts: list) -> pa.RecordBatch:
        return _batch([np.concatenate(x) for x in parts], ["gram", "sig", "n", "place"], [pa.int64(), pa.int64(), pa.int32(), pa.int32()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            grams, sigs, sizes, places, held = [], [], [], [], 0
            for _, values in sets_of(batch.column(2), k):
                n = len(values)
                if not n:
                    continue
                length = min(n, n - int(least_common(n, percent)) + 1)
                order = np.lexsort((values, counts[(values >> U(64 - CELLS_LOG)).astype(np.int64)]))[:length]
                grams.append(values[order].view(np.int64))
                sigs.append(np.full(length, signature(values)))
                sizes.append(np.full(length, n, dtype=np.int32))
                places.append(np.arange(length, dtype=np.int32))
                held += length
                if held > 200_000:
                    yield whole(grams, sigs, sizes, places)
                    grams, sigs, sizes, places, held = [], [], [], [], 0
            if held:
                yield whole(grams, sigs, sizes, places)

    return map_arrow(keyed, run, "gram long, sig long, n int, place int")


def _common_of(n: str, m: str, percent: int) -> Column:
    """N-grams that linked sets of these sizes have in common: at least this."""
    return F.ceil(percent * (F.col(n) + F.col(m)) / (100 + percent))


def _common(x: str, y: str, percent: int) -> Column:
    return _common_of(f"{x}.n", f"{y}.n", percent)


def _sizes(x: str, y: str, percent: int) -> Column:
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _apart(x: str, y: str) -> Column:
    """Slots in which the parities of two sets differ."""
    return sum((F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in BITS[1:]), F.bit_count(F.col(f"{x}.{BITS[0]}").bitwiseXOR(F.col(f"{y}.{BITS[0]}"))))


def _near(x: str, y: str, percent: int) -> Column:
    """Bounds by the sizes and by the parities."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    return _sizes(x, y, percent) & (_apart(x, y) <= n + m - 2 * _common(x, y, percent))


def _product(open_rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets that are not connected, with the distance of their parities.

    x is the larger set, or of equal ones that with the greater name. The n-grams in common
    come in the same order in both sets; those within the places below are the first of them,
    so at most as many are left as either set has behind the last one met."""
    def left_out(n: Column) -> Column:  # for the partner that allows most
        return n - F.ceil(2 * percent * n / (100 + percent))

    x, y = open_rows.alias("x"), open_rows.where(F.col("place") <= left_out(F.col("n"))).alias("y")
    common = _common("x", "y", percent)
    ordered = (F.col("x.n") > F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.sig") > F.col("y.sig")))
    places = (F.col("x.place") <= F.col("x.n") - common) & (F.col("y.place") <= F.col("y.n") - common)
    rows = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.component") != F.col("y.component")) & ordered & places & _near("x", "y", percent)).select(
        F.col("x.sig").alias("a"), F.col("y.sig").alias("b"), common.alias("common"), _apart("x", "y").alias("apart"),
        F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) - 1)
    rows = rows.toDF("a", "b", "common", "apart", "left")
    met = rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("met"), F.min("left").alias("left"), F.max("common").alias("common"), F.max("apart").alias("apart"))
    return met.where(F.col("met") + F.col("left") >= F.col("common")).select("a", "b", "apart")


def _linked(scratch: Scratch, pairs: DataFrame, keyed: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets are similar enough, written.

    Tallies of whole sets, a tenth of the bytes of a text, rule out most pairs of long sets, for
    which parities say nothing; the texts of the others meet and are compared exactly."""
    pairs = scratch.write(pairs.select("a", "b"), "jaccard-pairs")
    keys = scratch.write(_ends(pairs).join(classes, "sig").select("row_key", "sig"), "jaccard-needed")

    def to_tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, out = np.zeros(len(batch), np.int64), [b""] * len(batch)
            for row, values in sets_of(batch.column(1), k):
                sizes[row], out[row] = len(values), tallies(values).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(out, pa.binary())], names=["sig", "n", "tallies"])

    # Rows repeated with id and text have one key; the joins with the pairs would multiply them.
    known = map_arrow(_texts_of(keyed, keys), to_tallies, "sig long, n long, tallies binary").dropDuplicates(["sig"])
    sets = scratch.hold(written(known, "jaccard-sets"))
    both = pairs.join(sets.toDF("a", "n_a", "tallies_a"), "a").join(sets.toDF("b", "n_b", "tallies_b"), "b")

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            allowed = n - 2 * (-(-percent * n // (100 + percent)))
            apart = [tallies_apart(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)) for x, y in zip(batch.column(4), batch.column(5))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(np.array(apart, np.int64) <= allowed))

    near = scratch.write(map_arrow(both.select("a", "b", "n_a", "n_b", "tallies_a", "tallies_b"), possible, "a long, b long"), "jaccard-near")
    scratch.drop(pairs, sets)
    few = scratch.write(keys.join(_ends(near), "sig").select("row_key", "sig"), "jaccard-compared")
    scratch.drop(keys)
    # Shuffled by set once for both joins.
    texts = _texts_of(keyed, few).dropDuplicates(["sig"])
    both = near.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for (_, x), (_, y) in zip(sets_of(batch.column(2), k), sets_of(batch.column(3), k)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    links = scratch.write(map_arrow(both.select("a", "b", "text_a", "text_b"), compare, "a long, b long").distinct(), "jaccard-links")
    scratch.drop(near, few)
    return links


def _ends(pairs: DataFrame) -> DataFrame:
    """Sets of the pairs (a, b), each once."""
    return pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()


def _texts_of(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """(sig, text) of the rows whose key is among the keys. A key has 16 bytes; beyond the
    bound, the join shuffles the texts instead."""
    side = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return keyed.select("row_key", "text").join(side, "row_key").select("sig", "text")


def components(edges: DataFrame) -> DataFrame:
    """(sig, component): least name reachable, for every end of an edge (a, b). Labels spread
    to neighbours and along labels, so chains halve in each round."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")), "component-edges")
    labels = written(both.groupBy(F.col("a").alias("sig")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "component-labels")
    while True:
        near = both.join(labels.withColumnRenamed("sig", "b"), "b").groupBy(F.col("a").alias("sig")).agg(F.min("component").alias("near"))
        least = labels.join(near, "sig").select("sig", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("sig").alias("component"), F.col("component").alias("further"))
        after = written(least.join(jump, "component", "left").select("sig", "old", F.least("component", F.coalesce("further", "component")).alias("component")), "component-labels")
        if after.where("old <> component").isEmpty():
            return after.select("sig", "component")
        labels = after.select("sig", "component")


def jaccard_classes(docs: DataFrame, k: int = 3, percent: int = 90, id_column: str = "doc_id", text_column: str = "text", stars: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id``, ``row_key`` (hash
    of id and text), ``class_key`` (the same within a component, null without words).

    Sets of k-word shingles (A-Z lower-cased) link if their Jaccard index is at least
    ``percent`` hundredths; component_id is the least id that links reach. Texts with fewer
    words than k are one shingle; null texts and those without words have none, link with
    nothing and are components of their own. Rows with a null id take part; they count for
    no least id, and are null among themselves. Repeated rows fall in one component.
    Hashes of 64 bits stand for shingles and sets. ``stars``: rounds (at least 1) that join
    families to a member before the product; it bears on cost, not on results. An empty table gives an empty result.
    The result reads tables in ``scratch``, which a caller may drop after writing it.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    keyed = docs.select(F.xxhash64(F.col(id_column), F.col(text_column)).alias("row_key"), F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    first = scratch.write(_first_pass(keyed, k), "jaccard-first")
    rows = first.where("chunk is null").select("row_key", "doc_id", "n", "sig", *BITS)
    classes = scratch.write(rows.where("n > 0").groupBy("sig").agg(F.min("row_key").alias("row_key"), F.min("doc_id").alias("least_id"), *[F.max(b).alias(b) for b in BITS]), "jaccard-classes")
    labels = _labels(scratch, _prefixes(keyed, k, percent, _cell_counts(first)), keyed, classes, k, percent, stars)
    named = classes.drop(*BITS).join(labels, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_sig = scratch.write(named.join(least, "component").select("sig", "component", "component_id"), "jaccard-components")
    scratch.drop(classes)
    by_sig = by_sig.withColumnRenamed("sig", "own")
    return rows.join(by_sig, (F.col("sig") == F.col("own")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "row_key", F.col("component").alias("class_key"))


def one_per_class(docs: DataFrame, k: int = 5, percent: int = 80, stars: int = 3) -> DataFrame:
    """The documents, of each component only the one with the least id. Texts without words
    all stay. Of repeated rows that are the one, one stays.

    Only the keys of the documents that go are matched with the texts, by broadcast if they
    are few enough; the texts then do not move."""
    scratch = Scratch(docs.sparkSession)
    found = written(jaccard_classes(docs, k, percent, stars=stars, scratch=scratch).where("class_key is not null").select("row_key", "doc_id", "class_key"), "jaccard-found")
    scratch.drop_all()
    first = found.groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first")).select("class_key", F.col("first.row_key").alias("first_key"))
    marked = found.groupBy("class_key", "row_key").agg(F.count(F.lit(1)).alias("rows")).join(first, "class_key")
    marked = written(marked.withColumn("stays", F.col("row_key") == F.col("first_key")).where("not stays or rows > 1").select("row_key", "stays"), "jaccard-marked")
    side = F.broadcast(marked) if marked.count() <= BROADCAST_KEYS else marked
    row = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__row"), F.xxhash64(F.col("doc_id"), F.col("text")).alias("row_key"))
    joined = row.join(side, "row_key", "left")
    whole = joined.where("stays is null").select("__row.*")
    repeats = joined.where("stays").dropDuplicates(["row_key"]).select("__row.*")
    return whole.union(repeats)


def _labels(scratch: Scratch, incidences: DataFrame, keyed: DataFrame, classes: DataFrame, k: int, percent: int, stars: int) -> DataFrame:
    """(sig, component) of the sets that have links."""
    grams = scratch.write(incidences, "jaccard-grams")
    shared = grams.groupBy("gram").agg(F.min("sig").alias("low"), F.max("sig").alias("high")).where("low < high").select("gram")
    # Only columns with two sets or more are multiplied; copies of a set are one.
    own = scratch.write(grams.join(shared, "gram").groupBy("gram", "sig").agg(F.first("n").alias("n"), F.first("place").alias("place")), "jaccard-shared")
    scratch.drop(grams)
    # One member of each column against the others. The parities join the pairs, of which
    # there are far fewer than incidences.
    bits = classes.select("sig", *BITS)
    marked, links, labels = own.withColumn("component", F.col("sig")), None, None
    for turn in range(stars):
        heads = marked.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                           F.min_by(F.struct("sig", "n", "component"), F.xxhash64("sig", F.lit(turn))).alias("head")).where("low < high")
        x, y = marked.alias("x"), heads.select("gram", "head.*").alias("y")
        met = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.component") != F.col("y.component")) & _sizes("x", "y", percent)).select(
            F.greatest("x.sig", "y.sig").alias("a"), F.least("x.sig", "y.sig").alias("b"), F.when(F.col("x.sig") > F.col("y.sig"), F.col("x.n")).otherwise(F.col("y.n")).alias("n_a"),
            F.when(F.col("x.sig") > F.col("y.sig"), F.col("y.n")).otherwise(F.col("x.n")).alias("n_b")).distinct()
        x, y = bits.alias("x"), bits.alias("y")
        pairs = met.join(x, F.col("a") == F.col("x.sig")).join(y, (F.col("b") == F.col("y.sig")) & (_apart("x", "y") <= F.col("n_a") + F.col("n_b") - 2 * _common_of("n_a", "n_b", percent)))
        marked, links, labels = _marked(own, links, _linked(scratch, pairs, keyed, classes, k, percent))
    # All pairs of sets that are not connected yet.
    still = marked.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("gram")
    left = scratch.write(marked.join(still, "gram").join(bits, "sig"), "jaccard-open")
    pairs = scratch.write(_product(left, percent), "jaccard-meetings")
    scratch.drop(left)
    # Each set's nearest partner first; what these connect need not be compared.
    ends = pairs.select(F.col("a").alias("end"), "a", "b", "apart").union(pairs.select("b", "a", "b", "apart"))
    best = scratch.write(ends.groupBy("end").agg(F.min(F.struct("apart", "a", "b")).alias("p")).select("p.a", "p.b").distinct(), "jaccard-best")
    _, links, labels = _marked(own, links, _linked(scratch, best, keyed, classes, k, percent))
    scratch.drop(own)
    rest = pairs
    for end in ("a", "b"):
        rest = rest.join(labels.select(F.col("sig").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    rest = rest.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).join(best, ["a", "b"], "left_anti")
    links = links.union(_linked(scratch, rest, keyed, classes, k, percent))
    scratch.drop(pairs, best)
    return components(links)


def _marked(own: DataFrame, links: DataFrame | None, found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Incidences with their component, all links, and components, after more links."""
    links = found if links is None else links.union(found)
    labels = components(links)
    return own.join(labels, "sig", "left").withColumn("component", F.coalesce("component", "sig")), links, labels
