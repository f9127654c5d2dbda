"""Near-duplicate embeddings by NN-descent.

Exact copies (same label and vector) are one vertex with a weight.  Vertices that link to a
pivot found next to them make its home: a few random-projection orders (vectors sorted by the
signs of random projections, in blocks) are searched for pivots, and a vertex joins
the first one it links to.  A dense group becomes a few homes, and NN-descent runs on pivots.
A pivot counts as a ball as wide as its farthest member, and two balls are as similar as
the cosine of the gap between them, so every link of two members shows as a near pair of balls.
Pivots without members are points, for which this is the cosine of the vectors.

Balls start with neighbours from further orders.  A round then compares the neighbours of
each ball, in either direction, with each other (neighbours of neighbours) and keeps the best
``k`` of each.  A list whose worst member still passes the threshold is saturated
and doubles.  Every pair seen at or above the threshold is near, whatever the lists keep.
Rounds go on until few lists change and none is saturated; then a fixed number
of pivots is compared with all others (audit), and while the share of their near pairs
found is below ``RECALL``, further orders and rounds follow; if it stays below, a warning
says so.

Near points are links.  The members of near homes, and those of one home, are compared in a tile
each, which gives the links counted per vertex and one row per vertex to the smallest one
it reaches there: pairs of vertices of a dense group are counted, never written.

Vectors are compared only if labels are equal and not null, and lengths agree, by cosine in
double precision.  A vector that is null or zero, or holds null or non-finite
components, links with nothing, as does a row with a null id.  Rows that share
an id are vectors of one vertex id.  Columns other than id, label and vector are not read.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerweave.llm.components import components
from ledgerweave.sources.shared import write_through

THRESHOLD = 0.98
K = 10
ORDERS = 4
BLOCK = 128
ROUNDS = 8
SETTLED = 0.002
AUDITED = 256
RECALL = 0.99
PART = 128          # members of a neighbourhood that are compared at once

HOME_BLOCK = 512    # vectors among which pivots are looked for; a home has at most
HOME_ORDERS = 4     # HOME_BLOCK members from each of these orders
SLACK = 1e-6        # radians added to the radius of a ball against rounding

PAIRS = "a long, b long, cosine double"


def usable() -> Column:
    """Vectors of finite components, not all of them zero."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & v.isNotNull() & finite
            & F.exists(v, lambda x: x != 0))


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of one length as unit vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _codes(turn: int):
    """Signs of 32 random projections, drawn from turn and length alone."""
    def run(column: pa.Array) -> pa.Array:
        size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False))
        out = np.zeros(len(column), dtype=np.int64)
        for dim in np.unique(size):
            at = np.flatnonzero(size == dim)
            planes = np.random.default_rng([turn, int(dim)]).standard_normal((int(dim), 32))
            signs = _unit(column.take(pa.array(at))) @ planes > 0
            out[at] = signs @ (1 << np.arange(31, -1, -1, dtype=np.int64))
        return pa.array(out)
    return F.arrow_udf(run, "long")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int
            ) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal keys, cut into pieces of at most ``most`` rows."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
        if not table.num_rows:
            continue
        rest = table.to_batches()[0]
        cols = [rest.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(rest.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        edges = np.concatenate(([0], np.flatnonzero(new), [rest.num_rows]))
        for a, b in zip(edges[:-2], edges[1:-1]):
            for i in range(a, b, most):
                yield rest.slice(i, min(most, b - i))
        rest = rest.slice(edges[-2])
        while rest.num_rows > most:
            yield rest.slice(0, most)
            rest = rest.slice(most)
    if rest is not None and rest.num_rows:
        yield rest


def _batch(a: list, b: list, cosine: list) -> pa.RecordBatch:
    flat = [np.concatenate(x) if x else np.zeros(0) for x in (a, b, cosine)]
    return pa.RecordBatch.from_arrays(
        [pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)),
         pa.array(flat[2].astype(np.float64))], ["a", "b", "cosine"])


def _gap(cosine: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosines of the gaps between balls; where both are points, the cosines as they are."""
    reach = left[:, None] + right[None, :]
    wide = reach > 0
    if wide.any():
        angle = np.arccos(np.clip(cosine[wide], -1, 1)) - reach[wide]
        cosine[wide] = np.cos(np.maximum(angle, 0))
    return cosine


def _alike(block: pa.RecordBatch) -> np.ndarray:
    """How similar the balls of a block are to each other."""
    unit, radius = _unit(block.column("embedding")), block.column("radius").to_numpy()
    return _gap(unit @ unit.T, radius, radius)


def _homes(points: DataFrame, least: float) -> DataFrame:
    """(id, home, cosine) of every vertex; a pivot is its own home.

    Members of a pivot leave before the next order; a pivot that has members stays one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, ["space"], HOME_BLOCK):
            ids, unit = block.column("id").to_numpy(), _unit(block.column("embedding"))
            settled = block.column("settled").to_numpy(zero_copy_only=False)
            home, near = np.full(len(ids), -1), np.ones(len(ids))
            home[settled] = np.flatnonzero(settled)
            cosine = unit @ unit.T
            for i in np.argsort(~settled, kind="stable"):    # pivots that have members come first
                if home[i] >= 0 and home[i] != i:
                    continue
                home[i] = i
                mine = np.flatnonzero((cosine[i] >= least) & (home < 0))
                home[mine], near[mine] = i, cosine[i, mine]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(ids[home]), pa.array(near)], ["id", "home", "cosine"])

    left, placed = points.select("id", "space", "embedding", F.lit(False).alias("settled")), None
    for turn in range(HOME_ORDERS):
        code = _codes(1000 + turn)("embedding")
        rows = left.withColumn("code", code).repartitionByRange("space", "code", "id")
        rows = rows.sortWithinPartitions("space", "code", "id").drop("code")
        now = write_through(rows.mapInArrow(run, "id long, home long, cosine double"))
        members = now.where("id <> home")
        placed = members if placed is None else placed.union(members)
        owners = members.select(F.col("home").alias("id")).distinct().withColumn("owns", F.lit(True))
        left = write_through(
            left.join(members.select("id"), "id", "left_anti").join(owners, "id", "left")
            .select("id", "space", "embedding",
                    (F.col("settled") | F.coalesce("owns", F.lit(False))).alias("settled")))
    return placed.union(left.select("id", F.col("id").alias("home"), F.lit(1.0)))


def _tiles(homes: DataFrame, near: DataFrame, least: float) -> DataFrame:
    """(id, n, low): in each tile, the weight of a vertex's links and the smallest vertex it
    reaches; ``homes`` has (home, id, weight, embedding), ``near`` the pairs (p, q) of homes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _groups(batches, ["p", "q"], 2 * HOME_BLOCK * (HOME_ORDERS + 1)):
            ids, weight = tile.column("id").to_numpy(), tile.column("weight").to_numpy()
            unit, right = _unit(tile.column("embedding")), tile.column("right").to_numpy()
            x, y = np.flatnonzero(right == 0), np.flatnonzero(right == 1)
            if not len(y):                      # a home with itself
                y = x
            linked = unit[x] @ unit[y].T >= least
            linked &= ids[x][:, None] != ids[y][None, :]
            n = np.zeros(len(ids), dtype=np.int64)
            n[x] = linked @ weight[y]
            if y is not x:
                n[y] = weight[x] @ linked
            low = ids.copy()
            while True:                         # the smallest id spreads along the links
                before = low.copy()
                for i in np.flatnonzero(linked.any(axis=1)):
                    at = y[linked[i]]
                    least_id = min(low[x[i]], low[at].min())
                    low[x[i]] = least_id
                    low[at] = least_id
                if (low == before).all():
                    break
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(n[some]), pa.array(low[some])], ["id", "n", "low"])

    def side(column: str, right: int, pairs: DataFrame) -> DataFrame:
        return (pairs.join(homes, pairs[column] == homes["home"])
                .select("p", "q", F.lit(right).alias("right"), "id", "weight", "embedding"))
    rows = side("p", 0, near).union(side("q", 1, near.where("p <> q")))
    rows = rows.repartition("p", "q").sortWithinPartitions("p", "q")
    return rows.mapInArrow(run, "id long, n long, low long")


def _first_neighbours(points: DataFrame, turn: int, k: int, least: float) -> DataFrame:
    """The best k of each vertex, and all links, in blocks of one random order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = ([], [], []), 0
        for block in _groups(batches, ["space"], BLOCK):
            ids, cosine = block.column("id").to_numpy(), _alike(block)
            np.fill_diagonal(cosine, -2)
            worst = np.sort(cosine, axis=1)[:, -min(k, len(ids))][:, None]
            a, b = np.nonzero(((cosine >= worst) | (cosine >= least)) & (cosine > -2))
            for x, y in zip(out, (ids[a], ids[b], cosine[a, b])):
                x.append(y)
            n += len(a)
            if n > 50_000:
                yield _batch(*out)
                out, n = ([], [], []), 0
        yield _batch(*out)
    code = _codes(turn)("embedding")
    rows = points.select("id", "space", "embedding", "radius", code.alias("code"))
    rows = rows.repartitionByRange("space", "code", "id").sortWithinPartitions("space", "code", "id")
    return rows.select("id", "space", "embedding", "radius").mapInArrow(run, PAIRS)


def _best(pairs: DataFrame, sizes: DataFrame | None, k: int) -> DataFrame:
    """The best pairs of each vertex by its own list size."""
    order = Window.partitionBy("a").orderBy(F.col("cosine").desc(), "b")
    ranked = pairs.dropDuplicates(["a", "b"]).withColumn("rank", F.row_number().over(order))
    if sizes is None:
        return ranked.where(F.col("rank") <= k).drop("rank")
    size = F.coalesce("size", F.lit(k))
    return ranked.join(sizes, "a", "left").where(F.col("rank") <= size).select("a", "b", "cosine")


def _local_join(points: DataFrame, graph: DataFrame, least: float, turn: int) -> DataFrame:
    """Compares neighbours of each ball; pairs better than either end's worst, and near pairs.

    The neighbourhood of a hub is dealt into parts by hash and compared within them, so
    no task holds more than a part; each turn deals it anew, so other pairs meet.
    """
    worst = graph.groupBy("a").agg(F.min("cosine").alias("worst"))
    either = (graph.select(F.col("a").alias("of"), F.col("b").alias("id"))
              .union(graph.select(F.col("b").alias("of"), F.col("a").alias("id"))).distinct())
    parts = either.groupBy("of").agg(F.ceil(F.count("*") / PART).alias("parts"))
    known = points.select("id", "embedding", "radius").join(worst.withColumnRenamed("a", "id"), "id", "left")
    rows = (either.join(parts, "of").withColumn("part", F.pmod(F.xxhash64("id", F.lit(turn)), "parts"))
            .select("of", "part", "id").join(known, "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = ([], [], []), 0
        for block in _groups(batches, ["of", "part"], 4 * PART):
            ids, cosine = block.column("id").to_numpy(), _alike(block)
            bound = block.column("worst").fill_null(-2.0).to_numpy()
            np.fill_diagonal(cosine, -3)
            a, b = np.nonzero((cosine > np.minimum(bound[:, None], least)) & (cosine > -3))
            for x, y in zip(out, (ids[a], ids[b], cosine[a, b])):
                x.append(y)
            n += len(a)
            if n > 50_000:
                yield _batch(*out)
                out, n = ([], [], []), 0
        yield _batch(*out)
    rows = rows.repartition("of", "part").sortWithinPartitions("of", "part")
    return rows.select("of", "part", "id", "embedding", "radius", "worst").mapInArrow(run, PAIRS)


def _audit(points: DataFrame, least: float) -> DataFrame:
    """All near pairs of about AUDITED balls, by comparison with every ball in blocks."""
    n = points.count()
    some = points.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // AUDITED))) == 0)
    asked = some.limit(2 * AUDITED).select("id", "space", "embedding", "radius").toArrow()
    spaces = asked.column("space").to_pylist()
    queries = {s: (asked.column("id").to_numpy()[np.array(spaces) == s], _unit(
        asked.column("embedding").combine_chunks().filter(pa.array(np.array(spaces) == s))),
        asked.column("radius").to_numpy()[np.array(spaces) == s]) for s in set(spaces)}
    shared = points.sparkSession.sparkContext.broadcast(queries)    # 2 * AUDITED vectors at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            space = batch.column("space").to_numpy(zero_copy_only=False)
            out = ([], [], [])
            for s, (ids, unit, radius) in shared.value.items():
                at = np.flatnonzero(space == s)
                if len(at):
                    cosine = _gap(unit @ _unit(batch.column("embedding").take(pa.array(at))).T,
                                  radius, batch.column("radius").to_numpy()[at])
                    mine = batch.column("id").to_numpy()[at]
                    a, b = np.nonzero((cosine >= least) & (ids[:, None] != mine[None, :]))
                    for x, y in zip(out, (ids[a], mine[b], cosine[a, b])):
                        x.append(y)
            yield _batch(*out)
    return points.select("id", "space", "embedding", "radius").mapInArrow(run, PAIRS)


def links(points: DataFrame, least: float = THRESHOLD, k: int = K) -> tuple[DataFrame, float]:
    """(a, b, cosine) of near balls in both directions, and the recall measured.

    ``points`` has (id, space, embedding, radius); balls are compared within a space.
    """
    found, graph, recall = None, None, 1.0
    for again in range(4):
        new = None
        for turn in range(again * ORDERS, (again + 1) * ORDERS):
            part = _first_neighbours(points, turn, k, least)
            new = part if new is None else new.union(part)
        graph = write_through(new if graph is None else new.union(graph))
        found = _linked(found, graph, least)
        graph, sizes = write_through(_best(graph, None, k)), None
        for turn in range(ROUNDS):
            seen = write_through(_local_join(points, graph, least, again * ROUNDS + turn))
            found = _linked(found, seen, least)
            better = write_through(_best(graph.union(seen), sizes, k))
            lists = better.groupBy("a").agg(F.count("*").alias("n"), F.min("cosine").alias("w"))
            full = F.col("n") >= (F.coalesce("size", F.lit(k)) if sizes is not None else F.lit(k))
            grown = (lists if sizes is None else lists.join(sizes, "a", "left"))
            now = grown.where(full & (F.col("w") >= least)).select("a", (2 * F.col("n")).alias("size"))
            now = write_through(now if sizes is None else now.union(
                sizes.join(now.select("a"), "a", "left_anti")))
            total, change = better.count(), better.join(graph, ["a", "b"], "left_anti").count()
            enlarged = now.count() if sizes is None else now.exceptAll(sizes).count()
            graph, sizes = better, now
            if change <= SETTLED * total and not enlarged:
                break
        true = write_through(_audit(points, least))
        all_, hit = true.count(), true.join(found, ["a", "b"], "left_semi").count()
        recall = hit / all_ if all_ else 1.0
        found = _linked(found, true, least)
        if recall >= RECALL:
            break
    return found, recall


def _linked(found: DataFrame | None, pairs: DataFrame, least: float) -> DataFrame:
    """The links so far and those among the pairs, in both directions."""
    new = pairs.where(F.col("cosine") >= least)
    new = new.union(new.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine"))
    return write_through((new if found is None else new.union(found)).dropDuplicates(["a", "b"]))


def near_duplicates(vectors: DataFrame, least: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    whole = rows.where(usable())
    key = ["label", "embedding"]
    # Two hashes, 128 bits, stand for a vector where rows are joined to it.
    digest = [F.xxhash64(*key).alias("_key"), F.xxhash64(F.lit(1), *key).alias("_more")]
    points = write_through(
        whole.groupBy(*key).agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
        .select("id", "weight", "embedding", *digest,
                F.xxhash64("label", F.size("embedding")).alias("space")))
    homes = write_through(_homes(points, least))
    wide = homes.groupBy("home").agg(F.min("cosine").alias("cosine"), F.count("*").alias("n"))
    radius = F.acos(F.least(F.lit(1.0), "cosine")) + SLACK
    balls = write_through(points.join(wide, points["id"] == wide["home"]).select(
        "id", "space", "embedding", F.when(F.col("n") > 1, radius).otherwise(0.0).alias("radius")))
    near, recall = links(balls, least)
    if recall < RECALL:
        warnings.warn(f"a share of {recall:.4f} of the audited near pairs was found", stacklevel=2)
    owner = balls.where("radius > 0").select("id")
    alone = (near.join(owner, near["a"] == owner["id"], "left_anti")
             .join(owner, near["b"] == owner["id"], "left_anti"))
    tiled = (near.where("a < b").join(alone, ["a", "b"], "left_anti")
             .select(F.col("a").alias("p"), F.col("b").alias("q"))
             .union(owner.select(F.col("id").alias("p"), F.col("id").alias("q"))))
    member = homes.select("home", "id").join(points.select("id", "weight", "embedding"), "id")
    inside = write_through(_tiles(member, tiled, least))
    weight = points.groupBy(F.col("id").alias("b")).agg(F.sum("weight").alias("n"))
    around = (alone.join(weight, "b").select(F.col("a").alias("id"), "n")
              .union(inside.select("id", "n")).groupBy("id").agg(F.sum("n").alias("around")))
    parts = components(alone.select("a", "b").union(inside.select("id", "low")))
    facts = write_through(
        points.select("id", "weight", "_key", "_more").join(around, "id", "left")
        .join(parts.withColumnRenamed("node", "id"), "id", "left")
        .select("_key", "_more", F.col("id").alias("_rep"), "weight", "around", "component"))
    member = write_through(
        rows.where(usable()).select("vec_id", *digest).join(facts, ["_key", "_more"])
        .select("vec_id", (F.coalesce("around", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "_rep").alias("component_id")))
    rest = rows.where(~F.coalesce(usable(), F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (member.unionByName(rest)
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
