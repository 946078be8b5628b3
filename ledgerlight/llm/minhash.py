"""Near-duplicates: SuperMinHash signatures, banding, verification on full shingle sets, union-find grouping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm import text
from ledgerlight.llm.components import connected
from ledgerlight.session import cut, scratch_dir, scratch_scope

SLOTS = 512
BAND_ROWS = 8
# Shingles of the sets that one task compares with one another at once.
OTHERS_BLOCK, ALL_BLOCK = 1_000_000, 3_000_000
_U = np.uint64


def super_minhash(elements: np.ndarray, row: np.ndarray, rows: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (rows x slots) of rows given as element hashes and their row numbers.

    Element e puts the value j + r(e, j) into slot p_e(j) for the ranks j = 0, 1, ...; p_e is a permutation of the
    slots, so an element's ranks are correlated over the slots: each rank goes to one slot only. A slot keeps its least
    value. All values of rank j lie in [j, j + 1), so a row whose slots were all filled by ranks up to j stops there.
    Rows without elements keep infinity. `slots` is a power of two.
    """
    bits = _U(slots.bit_length() - 1)
    low = _U(slots - 1)
    half = max(_U(1), bits // _U(2))
    sig = np.full(rows * slots, np.inf)
    alive = np.zeros(rows, dtype=bool)
    alive[row] = True
    for rank in range(slots):
        if not len(elements):
            break
        x = (_U(rank) * (elements >> _U(3) | _U(1)) + (elements >> _U(17))) & low
        x ^= x >> half
        x = (x * (elements >> _U(29) | _U(1)) + (elements >> _U(43))) & low
        x ^= x >> half
        r = text.mix(elements + _U((rank + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> _U(11)
        np.minimum.at(sig, row * slots + x.astype(np.int64), rank + r * 2.0**-53)
        open_rows = np.flatnonzero(alive)
        full = sig.reshape(rows, slots)[open_rows].max(axis=1) < np.inf
        if full.any():
            alive[open_rows[full]] = False
            go_on = alive[row]
            elements, row = elements[go_on], row[go_on]
    return sig.reshape(rows, slots)


def band_keys(sig: np.ndarray, band_rows: int = BAND_ROWS) -> np.ndarray:
    """A 64-bit key per band of slots; equal keys mean equal slots of the same band."""
    slots = sig.view(np.uint64).reshape(len(sig), -1, band_rows)
    keys = np.arange(slots.shape[1], dtype=np.uint64)[None, :] + _U(1)
    for k in range(band_rows):
        keys = text.mix(keys * _U(0xD1B54A32D192ED03) + slots[:, :, k])
    return keys


def _signer(shingle: int, slots: int, band_rows: int) -> Callable:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = slots // band_rows
        for batch in batches:
            for first, sets in text.word_shingles(batch.column("t"), shingle):
                n = np.array([len(s) for s in sets])
                elements = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
                row = np.repeat(np.arange(len(sets)), n)
                keys = band_keys(super_minhash(elements, row, len(sets), slots), band_rows)
                keys = keys.view(np.int64)[n > 0]
                at = np.concatenate(([0], np.cumsum(np.where(n > 0, width, 0)))).astype(np.int32)
                one = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                two = np.array([text.mix(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, len(sets)),
                        pa.array(n, pa.int64()),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(keys.ravel())),
                    ],
                    names=["id", "n", "s1", "s2", "bands"],
                )

    return sign


def _shingler(shingle: int) -> Callable:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in text.word_shingles(batch.column("t"), shingle):
                at = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, dtype=np.int64)
                ids = batch.column("id").slice(first, len(sets))
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(flat))
                yield pa.RecordBatch.from_arrays([ids, lists], names=["id", "shingles"])

    return make


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are alike enough."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    held = pairs.join(one, "a").join(two, "b").select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), both.alias("i"))
    return held.where(F.expr(f"100L * i >= {percent}L * (nx + ny - i)")).select("a", "b")


def _comparer(percent: int) -> Callable:
    def compare(others: pd.DataFrame, everyone: pd.DataFrame) -> pd.DataFrame:
        """Links between two blocks of a family, leaving out pairs that are in one component by then."""
        out: list[tuple[int, int]] = []
        if len(others) and len(everyone):
            label = {c: c for c in {*others["c"].tolist(), *everyone["c"].tolist()}}

            def root(c: int) -> int:
                while label[c] != c:
                    label[c] = label[label[c]]
                    c = label[c]
                return c

            ids, comps, n = everyone["id"].to_numpy(), everyone["c"].to_numpy(), everyone["n"].to_numpy()
            aside, sets = everyone["aside"].to_numpy(), everyone["shingles"].to_list()
            buckets: dict[int, list[int]] = {}
            for j, keys in enumerate(everyone["keys"]):
                for key in keys.tolist():
                    buckets.setdefault(key, []).append(j)
            for x, cx, nx, own, keys in zip(others["id"], others["c"], others["n"], others["shingles"], others["keys"], strict=True):
                met = np.unique([j for key in keys.tolist() for j in buckets.get(key, ())]).astype(np.int64)
                # Sets of too different sizes cannot be alike. Of two members of the smaller components, one looks at the other.
                fits = 100 * np.minimum(n[met], nx) >= percent * np.maximum(n[met], nx)
                met = met[fits & (ids[met] != x) & ~(aside[met] & (ids[met] < x))]
                met = met[[root(c) != root(cx) for c in comps[met].tolist()]] if len(met) else met
                if not len(met):
                    continue
                # Hashes ascend as unsigned numbers and come as signed ones, so they are not in order here.
                own = np.sort(own)
                flat = np.concatenate([sets[j] for j in met])
                at = np.minimum(np.searchsorted(own, flat), nx - 1)
                both = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(n[met]) - n[met])
                for j in met[100 * both >= percent * (nx + n[met] - both)]:
                    a, b = root(cx), root(comps[j])
                    if a != b:
                        label[max(a, b)] = min(a, b)
                        out.append((x, int(ids[j])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return compare


def _within(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components inside the buckets of `left` (key, id, n, c).

    Buckets that share members are a family. A member is in one family and knows its buckets, of which it has no more
    than bands, so its set travels once, however many buckets it is in. Members of a family's largest component are
    compared with those of its others only, where they share a bucket. Both sides are cut into blocks of bounded size,
    every pair of blocks is a group of its own, and only links leave it.
    """
    leaders = left.groupBy("key").agg(F.min("id").alias("leader"))
    families = connected(left.join(leaders, "key").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct())
    rows = left.groupBy("id").agg(F.any_value("n").alias("n"), F.any_value("c").alias("c"), F.collect_set("key").alias("keys"))
    rows = cut(rows.join(families.select(F.col("node").alias("id"), F.col("component").alias("family")), "id"), "families")
    sizes = rows.groupBy("family", "c").agg(F.count("*").alias("rows"), F.sum("n").alias("s"))
    whole = sizes.groupBy("family").agg(F.max(F.struct("rows", "c", "s")).alias("main"), F.sum("s").alias("s"))
    blocks = whole.where("s > main.s").select(
        "family",
        F.col("main.c").alias("main"),
        F.ceil((F.col("s") - F.col("main.s")) / OTHERS_BLOCK).cast("int").alias("na"),
        F.ceil(F.col("s") / ALL_BLOCK).cast("int").alias("nb"),
    )
    held = rows.join(blocks, "family").withColumn("aside", F.col("c") != F.col("main")).drop("main")
    members = held.drop("n").join(sets, "id").withColumn("n", F.size("shingles")).where("n > 0")

    def part(count: str):
        return F.pmod(F.xxhash64("id", F.lit(7)), F.col(count)).cast("int")

    def numbers(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    columns = ["family", "id", "n", "c", "keys", "shingles"]
    others = members.where("aside").select(*columns, part("na").alias("i"), numbers("nb").alias("j"))
    # Named anew, as both sides are made of the same rows.
    everyone = members.select(*[F.col(c).alias(c) for c in [*columns, "aside"]], part("nb").alias("j"), numbers("na").alias("i"))
    return others.groupBy("family", "i", "j").cogroup(everyone.groupBy("family", "i", "j")).applyInPandas(_comparer(percent), "a long, b long")


def _labels(named: DataFrame, keys: DataFrame, buckets: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, component) of all nodes that have links, from the members of the buckets."""
    members = cut(keys.join(buckets.select("key", "members", "leader"), "key"), "members")
    wanted = members.select("id").distinct()
    sets = named.join(wanted.hint("shuffle_hash"), "id", "left_semi")
    sets = cut(sets.mapInArrow(_shingler(shingle), "id long, shingles array<long>"), "sets")
    first = members.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    labels = cut(connected(_confirmed(first, sets, percent)), "labels")

    def labelled(rows: DataFrame) -> DataFrame:
        named = labels.withColumnRenamed("node", "id")
        return rows.join(named, "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")

    def unfinished(rows: DataFrame) -> DataFrame:
        ends = rows.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y"))
        return ends.where("x <> y").select("key")

    # A bucket is done when it is one component, or has two members, which have met.
    seen = labelled(members.where("members > 2").select("key", "id", "n"))
    left = cut(seen.join(unfinished(seen), "key", "left_semi"), "left")
    if left.isEmpty():
        return labels
    known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected(known.union(_within(left, sets, percent)))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    slots: int = SLOTS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id that links lead to), kept (id = component_id).

    Two documents are linked when 100 * |A and B| >= percent * |A or B| for their sets of distinct `shingle`-word
    shingles (A-Z lower-cased, ASCII white space; with fewer words the whole sequence is the only shingle).

    Documents with equal sets are one node from the start. Nodes whose signatures agree in a whole band share a bucket;
    at 8 of 512 slots a band, a pair at 80 % shares none with probability 8e-6. In a bucket, members are first compared
    with the smallest member. That makes most buckets one component. In the
    others, members of different components are compared block by block inside tasks, where pairs that have come into
    one component meanwhile are passed over, and only links leave a task. So no link that could join two components
    stays untested, and a group of copies never becomes a table of its pairs. Set equality and intersections rest on 64-bit hashes (two of them for equality).

    Empty and null texts have no shingles and are linked with nothing. Rows that share an id are one document. Rows with
    a null id are linked with nothing, have a null component_id and are kept. An empty table gives no rows; further
    columns are ignored. Ids are longs.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    signed = cut(named.mapInArrow(_signer(shingle, slots, band_rows), "id long, n long, s1 long, s2 long, bands array<long>"), "signatures")
    real = signed.where("n > 0 AND id IS NOT NULL")
    nodes = cut(real.groupBy("s1", "s2", "n").agg(F.min("id").alias("id"), F.any_value("bands").alias("bands")), "nodes")
    # Dealt once, for counting the buckets and for finding their members again.
    keys = nodes.select("id", "n", F.explode("bands").alias("key")).repartition("key")

    buckets = keys.groupBy("key").agg(
        F.count("*").alias("members"), F.min("id").alias("leader"), F.bit_xor(F.xxhash64("id")).alias("mark")
    ).where("members > 1")
    # Bands with the same members are one bucket.
    buckets = buckets.groupBy("mark", "members", "leader").agg(F.min("key").alias("key"))
    path = scratch_dir(docs.sparkSession, "components")
    with scratch_scope(docs.sparkSession):
        labels = _labels(named, keys, buckets, shingle, percent)
        labels.write.parquet(path)
    labels = docs.sparkSession.read.schema(labels.schema).parquet(path)

    groups = nodes.select("s1", "s2", "n", F.col("id").alias("node")).join(labels, "node", "left")
    groups = groups.select("s1", "s2", F.col("n").alias("n_set"), F.coalesce("component", "node").alias("component"))
    same = (signed["s1"] == groups["s1"]) & (signed["s2"] == groups["s2"]) & (signed["n"] == groups["n_set"]) & signed["id"].isNotNull()
    rows = signed.drop("bands").join(groups.drop("n"), same, "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
