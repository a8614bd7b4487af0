"""Near copies among embeddings: hashing by E8 lattice cells.

A table projects every vector, brought to length 1, onto blocks of eight random
directions, scales the blocks and decodes each to the nearest point of the E8
lattice; all points together are the vector's cell. Vectors of nearly the same
direction mostly share a cell or lie in neighbouring ones, so each vector also
probes, in the block where it lies closest to a border, the next lattice points.
Vectors that meet in a table are verified by cosine in double precision.

Equal vectors are one class. Cells are cut into blocks of bounded size, and
pairs of blocks are compared as matrices, wherever they run: a task holds two
blocks, and sends out counts and a spanning forest of the links, not the pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.graph import components
from tillroll.llm.storage import saved

LEAST_COSINE = 0.98
TABLES = 4
#: Blocks of eight directions in each table, probes besides the own cell, and cells in a unit of length.
BLOCKS = 1
PROBES = 8
SCALE = 1.0
#: Vectors in a block of a cell.
BLOCK_ROWS = 1024


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row, doubled so that it is whole numbers: the better of the D8 point and the shifted one."""

    def nearest_d8(y: np.ndarray) -> np.ndarray:
        point = np.rint(y)
        off = y - point
        worst = np.abs(off).argmax(axis=1)
        row = np.arange(len(y))
        odd = point.sum(axis=1) % 2 != 0
        point[row[odd], worst[odd]] += np.where(off[row[odd], worst[odd]] >= 0, 1.0, -1.0)
        return point

    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], whole, half)).astype(np.int64)


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled: a point's neighbours."""
    found = []
    for i in range(8):
        for j in range(i + 1, 8):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = np.zeros(8, np.int64)
                    v[i], v[j] = a, b
                    found.append(v)
    for signs in range(256):
        v = np.array([1 if signs >> k & 1 else -1 for k in range(8)], np.int64)
        if (v < 0).sum() % 2 == 0:
            found.append(v)
    return np.array(found)


_NEIGHBOURS = _shortest()


def cells(vectors: np.ndarray, table: int, seed: int = 11) -> np.ndarray:
    """Hashes of each unit vector's own cell in a table (first column) and of its probes."""
    rng = np.random.Generator(np.random.PCG64(seed * 1000 + table))
    size = vectors.shape[1]
    directions = rng.standard_normal((size, 8 * BLOCKS))
    shift = rng.random(8 * BLOCKS)
    keys = rng.integers(1, 2**63, (BLOCKS, 8), np.int64) | 1
    at = vectors @ directions * SCALE + shift
    points, codes = [], []
    for b in range(BLOCKS):
        block = at[:, 8 * b : 8 * b + 8]
        points.append(nearest_e8(block))
        codes.append((points[-1] * keys[b]).sum(axis=1))
    own = np.bitwise_xor.reduce([c * np.int64(2 * b + 1) for b, c in enumerate(codes)], axis=0)
    near = []
    for b in range(BLOCKS):
        away = at[:, 8 * b : 8 * b + 8] - points[b] / 2
        # Distance to a neighbour's point falls with the product.
        near.append(away @ (_NEIGHBOURS.T / 2))
    closeness = np.concatenate(near, axis=1)
    best = np.argsort(-closeness, axis=1, kind="stable")[:, :PROBES]
    out = np.empty((len(vectors), 1 + PROBES), np.int64)
    out[:, 0] = own
    for k in range(PROBES):
        block, neighbour = best[:, k] // len(_NEIGHBOURS), best[:, k] % len(_NEIGHBOURS)
        changed = own.copy()
        for b in range(BLOCKS):
            here = block == b
            moved = ((points[b][here] + _NEIGHBOURS[neighbour[here]]) * keys[b]).sum(axis=1)
            changed[here] ^= (codes[b][here] * np.int64(2 * b + 1)) ^ (moved * np.int64(2 * b + 1))
        out[:, 1 + k] = changed
    return out


def _digest(label: int, raw: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(raw.tobytes(), digest_size=8, salt=label.to_bytes(8, "little", signed=True)).digest(), "little", signed=True)


def _described(frame: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """key as vec_id, and for usable vectors class, label and vector; others have a null class."""
    own = frame.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )

    def describe(batches):
        for batch in batches:
            classes, kept = [], []
            vectors, labels = batch.column("vector"), batch.column("label").to_pylist()
            for value, own_label in zip(vectors, labels, strict=True):
                x = None
                if own_label is not None and value.is_valid and not value.values.null_count:
                    x = value.values.to_numpy(zero_copy_only=False)
                    norm = np.linalg.norm(x / np.abs(x).max()) if len(x) and np.isfinite(x).all() and x.any() else 0.0
                    x = x / np.abs(x).max() / norm if norm else None
                classes.append(None if x is None else _digest(own_label, value.values.to_numpy(zero_copy_only=False) + 0.0))
                kept.append(x)
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(classes, pa.int64()), pa.array(kept, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "class", "vector"])

    return own.mapInArrow(describe, "vec_id long, label long, class long, vector array<double>")


def _with_codes(classes: DataFrame) -> DataFrame:
    """class, members, vector, and codes: for each table the own cell, then the probes."""

    def code(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("class", "members", "vector")]
            labels = batch.column("label").to_numpy()
            sizes = np.diff(batch.column("vector").offsets.to_numpy())
            codes = np.empty((len(sizes), TABLES * (1 + PROBES)), np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                vectors = np.array(batch.column("vector").take(pa.array(rows)).to_pylist())
                salt = (labels[rows] * np.int64(0x9E3779B97F4A7C1) + np.int64(int(size) * 0x2545F4914F6CDD1 % 2**62))[:, None]
                for t in range(TABLES):
                    codes[rows, t * (1 + PROBES) : (t + 1) * (1 + PROBES)] = (cells(vectors, t) + salt) * np.int64(2 * t + 3) + t
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(codes), pa.list_(pa.int64()))], names=["class", "members", "vector", "codes"])

    return classes.select("class", "members", "vector", "label").mapInArrow(
        code, "class long, members long, vector array<double>, codes array<long>"
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of equal (cell, a, b), which come one after the other."""
    rest: list[pa.Table] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "a", "b")], axis=1)
        starts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = [0, *starts.tolist(), len(keys)]
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            key = tuple(keys[start].tolist())
            if key != last and rest:
                yield pa.concat_tables(rest)
                rest = []
            last = key
            rest.append(table.slice(start, end - start))
    if rest:
        yield pa.concat_tables(rest)


def _meet(codes: np.ndarray, table: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the rows i and j share a cell of the table that one of them owns."""
    first = table * (1 + PROBES)
    own, probes = codes[:, first], codes[:, first + 1 : first + 1 + PROBES]
    return (own[i] == own[j]) | (probes[i] == own[j][:, None]).any(axis=1) | (probes[j] == own[i][:, None]).any(axis=1)


def _compared(group: pa.Table, least: float) -> Iterator[tuple[int, int | None, int]]:
    """(class, None, members linked) and (class, class, 0): the links counted here, and a forest over them."""
    if group.num_rows < 2:
        return
    classes, members = group["class"].to_numpy(), group["members"].to_numpy()
    own, block, table = group["own"].to_numpy(zero_copy_only=False), group["block"].to_numpy(), group["table"][0].as_py()
    a, b = group["a"][0].as_py(), group["b"][0].as_py()
    vectors, codes = (np.array(group[c].to_pylist()) for c in ("vector", "codes"))
    similar = vectors @ vectors.T >= least
    similar &= own[:, None] | own[None, :]
    if a != b:
        similar &= block[:, None] != block[None, :]
    i, j = np.nonzero(np.triu(similar, 1))
    for earlier in range(table):
        later = ~_meet(codes, earlier, i, j)
        i, j = i[later], j[later]
    # A pair may meet here and in the other's cell of this table: it counts where the smaller class is at home.
    at = table * (1 + PROBES)
    host, guest = np.where(own[i], i, j), np.where(own[i], j, i)
    back = (codes[host, at + 1 : at + 1 + PROBES] == codes[guest, at][:, None]).any(axis=1)
    counted = (own[i] & own[j]) | ~back | (classes[host] < classes[guest])
    i, j = i[counted], j[counted]
    if not len(i):
        return
    links = np.bincount(i, members[j], len(classes)) + np.bincount(j, members[i], len(classes))
    for row in np.flatnonzero(links):
        yield int(classes[row]), None, int(links[row])
    root = np.arange(len(classes))
    while True:
        least_root = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least_root)
        np.minimum.at(new, j, least_root)
        new = new[new]
        if (new == root).all():
            break
        root = new
    for row in np.flatnonzero(root != np.arange(len(classes))):
        yield int(classes[row]), int(classes[root[row]]), 0


def similar_vectors(
    frame: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = LEAST_COSINE
) -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable), kept.

    Rows are linked if their labels are equal and the cosine of their vectors is
    at least `least`; which pairs are looked at, the lattice tables decide, and
    no pair below is ever linked. A vector that is null, empty or zero, or holds
    a null or a non-finite number, or whose label is null, is linked with nothing
    and keeps its own id. Vectors of different lengths are never linked.
    Repeated rows are linked with each other. kept is whether vec_id is the
    component's id; a null vec_id is not kept. Other columns are left out, an
    empty table gives an empty one.
    """
    described = saved(_described(frame, key, vector, label))
    classes = saved(
        described.where("class is not null").groupBy("class").agg(
            F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("members"), F.first("label").alias("label"), F.first("vector").alias("vector")
        )
    )
    coded = saved(_with_codes(classes))
    each = coded.select("class", F.posexplode("codes").alias("place", "cell")).select(
        "class", "cell", (F.col("place") % (1 + PROBES) == 0).alias("own"), F.floor(F.col("place") / (1 + PROBES)).cast("int").alias("table")
    )
    many = each.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("own").alias("owned")).where("rows > 1 and owned")
    met = each.join(many.select("cell", "rows"), "cell")
    blocks = F.ceil(F.col("rows") / BLOCK_ROWS).cast("int")
    met = met.withColumn("block", F.pmod(F.xxhash64("class", "own"), blocks).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.select(
        "class", "cell", "own", "table", "block", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b")
    ).join(coded, "class")
    dealt = met.repartition("cell", "a", "b").sortWithinPartitions("cell", "a", "b")

    def compare(batches):
        out: list[tuple] = []
        for group in _groups(batches):
            out.extend(_compared(group, least))
            if len(out) > 50_000:
                yield _packed(out)
                out = []
        if out:
            yield _packed(out)

    found = saved(dealt.mapInArrow(compare, "class long, other long, links long"))
    counts = found.where("other is null").groupBy("class").agg(F.sum("links").alias("links"))
    hung = components(found.where("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b")))
    hung = hung.withColumnRenamed("node", "class")
    smallest = hung.join(classes.select("class", "least"), "class").groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = (
        classes.select("class", "members", "least")
        .join(counts, "class", "left")
        .join(hung.join(smallest, "component").select("class", "component_id"), "class", "left")
        .select(
            "class",
            (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        )
    )
    usable = described.where("class is not null").select("vec_id", "class").join(of_class, "class", "left")
    others = described.where("class is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    rows = usable.select("vec_id", "n_links", "component_id").unionByName(others)
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["class", "other", "links"])
