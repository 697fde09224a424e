"""Near copies among embeddings, by an inverted multi-index.

The halves of a unit vector are quantised by a codebook each; pairs of codewords form a
grid of cells, and a vector lives in the cell of its nearest pair. A search visits cells
by rising sum of the two distances (multi-sequence traversal: a heap over the two sorted
lists) until the sum exceeds that of the nearest cell by ``slack``. Every vector is indexed
and searches; a pair is found if either finds the other, and is then verified exactly.

The slack is fitted in one way at every size, on two sets of pairs, as the least with which
``RECALL`` of each is found. The first are made: sampled vectors and others at exactly the
least cosine from them, turned towards random directions and towards other sampled vectors;
all true links are closer. The second are the true links of sampled queries, compared with
all vectors by brute force; queries that are neighbours of each other are one group, and
every group weighs the same, however many copies it has. The geometry bounds the search
besides: for vectors x and y at a distance of d, x's excess for y's cell and y's for x's sum
up to 2 (x - y)(c_x - c_y) at most, so the smaller one is within d times the distance of the
two cells' codewords. Cells beyond that hold no neighbour and are never searched.

Codewords grow with the square root of the rows, so that a cell keeps about ``BLOCK``
vectors, and the sample they are fitted on grows with them. Vectors of all lengths share the
index, by as many components as the most common length has (shorter ones are filled with
zeros): no two vectors are farther apart there than they are. Only vectors of the same
length and label are compared, on all their components.

Equal vectors are one row with a count. Cells are cut into blocks of about ``BLOCK``
vectors, and a pair of blocks is a join key of its own: a task compares two blocks at a time
and returns counts and a spanning forest of the links, never all pairs.

Defined results: vectors without label, null, empty, zero, or with a null or non-finite
component have no links and are kept; vectors of different lengths have none with each
other; rows that share a vec_id are vectors of their own; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.graph import components
from martloom.llm.rows import map_columns, prepare, share_below
from martloom.session import stored

COSINE, RECALL = 0.93, 0.995
#: The least number of codewords of a half, and of sampled vectors; sampled vectors a codeword.
CODEWORDS, SAMPLE, SAMPLE_EACH, BLOCK, SEED = 32, 8000, 16, 512, 10
#: Queries that are compared with all vectors, and pairs that are made.
QUERIES, MADE = 512, 8000
#: Distance of unit vectors at the least cosine.
REACH = float(np.sqrt(2 - 2 * COSINE))
#: Steps in which the slack is fitted; unit vectors' halves lie within 4 of a codeword.
STEP, MOST_STEPS = 0.01, 400


def codebook(points: np.ndarray, k: int = CODEWORDS, rounds: int = 12) -> np.ndarray:
    """k-means, from evenly spaced points."""
    k = max(1, min(k, len(points)))
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = squared(points, centres).argmin(1)
        for c in range(k):
            own = points[near == c]
            if len(own):
                centres[c] = own.mean(0)
    return centres


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)[None, :])


class MultiIndex:
    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books = first, second
        self.gaps = squared(first, first), squared(second, second)

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.books[0].shape[1]
        return squared(unit[:, :half], self.books[0]), squared(unit[:, half:], self.books[1])

    def traverse(self, d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[float, int]]:
        """(sum of distances, cell) by rising sum."""
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        heap, pushed = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}
        while heap:
            total, i, j = heapq.heappop(heap)
            yield total, int(o1[i]) * len(d2) + int(o2[j])
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(d1) and b < len(d2) and (a, b) not in pushed:
                    pushed.add((a, b))
                    heapq.heappush(heap, (d1[o1[a]] + d2[o2[b]], a, b))

    def visited(self, d1: np.ndarray, d2: np.ndarray, slack: float) -> list[int]:
        out: list[int] = []
        limit = None
        for total, cell in self.traverse(d1, d2):
            if limit is None:
                limit = total + slack
            if total > limit:
                break
            out.append(cell)
        return out

    def reach(self, d1: np.ndarray, d2: np.ndarray, slack: float) -> list[int]:
        """The visited cells that can hold a neighbour."""
        g1, g2 = self.gaps[0][d1.argmin()], self.gaps[1][d2.argmin()]
        most = REACH * np.sqrt(g1.max() + g2.max())
        cells = np.array(self.visited(d1, d2, min(slack, most + 1e-9)))
        i, j = cells // len(d2), cells % len(d2)
        near = d1[i] + d2[j] - d1.min() - d2.min() <= REACH * np.sqrt(g1[i] + g2[j]) + 1e-9
        return cells[near].tolist()

    def excess(self, x1, x2, y1, y2) -> np.ndarray:
        """Slack with which either of two vectors' searches reaches the other's cell,
        from their distances to the codewords; row by row."""
        rows = np.arange(len(x1))
        to_y = x1[rows, y1.argmin(1)] + x2[rows, y2.argmin(1)] - x1.min(1) - x2.min(1)
        to_x = y1[rows, x1.argmin(1)] + y2[rows, x2.argmin(1)] - y1.min(1) - y2.min(1)
        return np.minimum(to_y, to_x)


def distinct_vectors(embeddings: DataFrame) -> DataFrame:
    """(id, label, embedding, unit, n): one row per label and vector that can link."""
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").filter(
        "label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 AND vec_id IS NOT NULL AND "
        "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    groups = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
    norm = F.expr("sqrt(aggregate(embedding, 0D, (a, x) -> a + double(x) * double(x)))")
    groups = groups.withColumn("norm", norm).filter("norm > 0").withColumn("dim", F.size("embedding"))
    unit = F.expr("transform(embedding, x -> double(x) / norm)")
    return groups.select("id", "label", "embedding", "norm", unit.alias("unit"), "n", "dim")


def _folded(vectors: list, width: int) -> np.ndarray:
    """The first ``width`` components, missing ones zero."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[:len(v)] = v[:width]
    return out


def groups_of(queries: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The least number of a query that each query is linked to."""
    near = (queries @ queries.T >= COSINE) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, True)
    group = np.arange(len(queries))
    while True:
        least = np.where(near, group[None, :], len(group)).min(1)
        if (least == group).all():
            return group
        group = least


def fitted_slack(rows: list[tuple[int, int, int]], group: np.ndarray) -> tuple[float, float]:
    """Slack, and the mean share of the groups' neighbours that it finds, from (query, step,
    neighbours). No slack is needed where there are no neighbours."""
    by_group = np.zeros((len(group), MOST_STEPS + 1))
    for query, step, n in rows:
        by_group[group[query], step] += n
    by_group = by_group[by_group.sum(1) > 0]
    if not len(by_group):
        return 0.0, 1.0
    held = (by_group.cumsum(1) / by_group.sum(1, keepdims=True)).mean(0)
    step = int(np.argmax(held >= RECALL))
    return step * STEP + 1e-9, float(held[step])


def made_neighbours(points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors at exactly the least cosine: points, and each turned towards a
    random direction or towards another point."""
    pick = np.random.default_rng(SEED)
    x = points[pick.integers(0, len(points), n)]
    to = pick.normal(size=x.shape)
    to[::2] = points[pick.integers(0, len(points), n)][::2]
    to -= (to * x).sum(1, keepdims=True) * x
    size = np.linalg.norm(to, axis=1, keepdims=True)
    some = size[:, 0] > 1e-9
    x, to = x[some], to[some] / size[some]
    return x, COSINE * x + np.sqrt(1 - COSINE ** 2) * to


def codewords(total: int) -> int:
    return max(CODEWORDS, int(np.ceil(np.sqrt(total / BLOCK))))


def fit(vectors: DataFrame, total: int, width: int) -> tuple[MultiIndex, float, float]:
    """Index, slack and the share of true neighbours that it finds, on the mean of the
    sampled groups."""
    k = codewords(total)
    most = max(SAMPLE, SAMPLE_EACH * k)
    sample = vectors.filter(share_below(F.col("id"), min(1.0, most / total), SEED)).select("unit")
    points = _folded([r[0] for r in sample.collect()], width)
    if not len(points):
        points = _folded([r[0] for r in vectors.select("unit").limit(1).collect()], width)
    half = (width + 1) // 2
    index = MultiIndex(codebook(points[:, :half], k), codebook(points[:, half:], k))
    x, y = made_neighbours(points, MADE)
    slack = 0.0
    if len(x):
        excess = index.excess(*index.distances(x), *index.distances(y))
        slack = float(np.quantile(excess, RECALL, method="higher")) + 1e-9
    found, recall = _drawn(vectors.filter(F.col("dim") == width), index, min(1.0, QUERIES / total), width)
    return index, max(slack, found), recall


def _drawn(vectors: DataFrame, index: MultiIndex, share: float, width: int) -> tuple[float, float]:
    asked = vectors.filter(share_below(F.col("id"), share, SEED + 1)).select("id", "label", "unit").collect()
    if not asked:
        return 0.0, 1.0
    q_id, q_label = np.array([r[0] for r in asked]), np.array([str(r[1]) for r in asked])
    queries = _folded([r[2] for r in asked], width)

    def make():
        q1, q2 = index.distances(queries)

        def work(ids, labels, units):
            x = _folded(units, width)
            hit = (x @ queries.T >= COSINE) & (np.array([str(v) for v in labels])[:, None] == q_label[None, :]) \
                & (np.array(ids)[:, None] != q_id[None, :])
            i, j = np.nonzero(hit)
            x1, x2 = index.distances(x)
            steps = np.ceil(index.excess(x1[i], x2[i], q1[j], q2[j]) / STEP).astype(np.int64)
            found, counts = np.unique(np.stack([j, np.minimum(steps, MOST_STEPS)]), axis=1, return_counts=True)
            return found[0].tolist(), found[1].tolist(), counts.tolist()
        return work

    fields = [("query", "long"), ("step", "long"), ("n", "long")]
    steps = map_columns(vectors, ["id", "label", "unit"], fields, make).groupBy("query", "step").agg(F.sum("n"))
    return fitted_slack([tuple(r) for r in steps.collect()], groups_of(queries, q_label))


def _blocks(members: DataFrame, block: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Members of each (label, cell) in blocks of about ``BLOCK``; how many there are."""
    sizes = members.groupBy("label", "cell").agg(F.ceil(F.count("*") / BLOCK).alias(f"{block}s"))
    blocks = (members.join(sizes, ["label", "cell"])
              .withColumn(block, F.pmod(F.xxhash64("id", F.lit(SEED)), F.col(f"{block}s")))
              .groupBy("label", "cell", block)
              .agg(F.collect_list(F.struct("id", "n", "embedding", "norm", *columns)).alias("m")))
    return blocks, sizes


def _each(blocks: DataFrame, sizes: DataFrame, block: str) -> DataFrame:
    """A copy for every block of the other side."""
    return blocks.join(sizes, ["label", "cell"]).withColumn(block, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{block}s") - 1)))


@dataclass(frozen=True)
class _Block:
    """Members of a block, straight from their Arrow columns."""

    ids: np.ndarray
    n: np.ndarray
    unit: np.ndarray
    rows: pa.StructArray

    @classmethod
    def of(cls, rows: pa.StructArray) -> _Block:
        field = lambda name: rows.field(name).to_numpy(zero_copy_only=False)
        raw = rows.field("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
        return cls(field("id"), field("n"), raw / field("norm")[:, None], rows)

    def numbers(self, name: str) -> np.ndarray:
        return self.rows.field(name).to_numpy(zero_copy_only=False)

    def seen(self, grid: int) -> np.ndarray:
        """Which cells each member's search visits."""
        cells = self.rows.field("cells")
        out = np.zeros((len(self.ids), grid), dtype=bool)
        row = np.repeat(np.arange(len(self.ids)), cells.value_lengths().to_numpy(zero_copy_only=False))
        out[row, cells.flatten().to_numpy(zero_copy_only=False)] = True
        return out


def _compare(p: _Block, r: _Block, grid: int):
    """Counts of links and a spanning forest (id, least id) for two blocks of a cell."""
    ids_p, ids_r, n_p, n_r = p.ids, r.ids, p.n, r.n
    hit = (p.unit @ r.unit.T >= COSINE) & (ids_p[:, None] != ids_r[None, :])
    if hit.any():
        # Where both find each other the pair counts on the side of the smaller id.
        hit &= ~(r.seen(grid)[:, p.numbers("own")].T & (ids_p[:, None] > ids_r[None, :]))
    links_p, links_r = hit @ n_r, hit.T @ n_p
    least_p, least_r = ids_p.copy(), ids_r.copy()
    i, j = np.nonzero(hit)
    while len(i):
        before = least_p.sum(dtype=object) + least_r.sum(dtype=object)
        np.minimum.at(least_r, j, least_p[i])
        np.minimum.at(least_p, i, least_r[j])
        if least_p.sum(dtype=object) + least_r.sum(dtype=object) == before:
            break
    return links_p, links_r, least_p, least_r


def verified(members: DataFrame, grid: int) -> DataFrame:
    """(a, b, n): counts of links of a where b is null, else an edge of the forest."""
    residents, r_sizes = _blocks(members.withColumn("cell", F.col("own")), "r_block", "cells")
    probes, p_sizes = _blocks(members.withColumn("cell", F.explode("cells")), "p_block", "own")
    keys = ["label", "cell", "r_block", "p_block"]
    pairs = _each(residents, p_sizes, "p_block").select(*keys, F.col("m").alias("r")).join(
        _each(probes, r_sizes, "r_block").select(*keys, F.col("m").alias("p")), keys)
    prepare(members.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r, p = (_Block.of(batch.column(c)[k].values) for c in (0, 1))
                links_p, links_r, least_p, least_r = _compare(p, r, grid)
                a, b, n = [], [], []
                for ids, links, least in ((p.ids, links_p, least_p), (r.ids, links_r, least_r)):
                    some, other = links > 0, ids != least
                    a += [pa.array(ids[some]), pa.array(ids[other])]
                    b += [pa.nulls(int(some.sum()), pa.int64()), pa.array(least[other])]
                    n += [pa.array(links[some]), pa.nulls(int(other.sum()), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in (a, b, n)], names=["a", "b", "n"])

    return pairs.select("r", "p").mapInArrow(run, "a long, b long, n long")


def near_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    vectors = stored(distinct_vectors(embeddings), "vectors")
    widths = vectors.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim")
    common, total = widths.first(), vectors.count()
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    if common is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    width = common["dim"]
    index, slack, _ = fit(vectors, total, width)
    grid = len(index.books[0]) * len(index.books[1])

    raw = embeddings.schema["embedding"].dataType.simpleString()

    def make():
        def work(ids, labels, units, own, norms, ns):
            d1, d2 = index.distances(_folded(units, width))
            cells = [index.reach(a, b, slack) for a, b in zip(d1, d2, strict=True)]
            return ids, labels, own, norms, ns, [c[0] for c in cells], cells
        return work

    labelled = vectors.withColumn("label", F.concat_ws("/", "dim", F.col("label").cast("string")))
    members = stored(map_columns(
        labelled, ["id", "label", "unit", "embedding", "norm", "n"],
        [("id", "long"), ("label", "string"), ("embedding", raw), ("norm", "double"), ("n", "long"), ("own", "long"), ("cells", "array<long>")],
        make), "vector_cells")
    found = stored(verified(members, grid), "vector_links")
    links = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("links"))
    classes = components(found.filter("b IS NOT NULL"))
    known = (vectors.select("id", F.col("label").alias("v_label"), F.col("embedding").alias("v_embedding"), "n")
             .join(links.withColumnRenamed("a", "id"), "id", "left")
             .join(classes.withColumnRenamed("node", "id"), "id", "left")
             .select("v_label", "v_embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                     F.coalesce("component", "id").alias("component")))
    known = stored(known, "vector_classes")
    out = rows.join(known, (F.col("label") == F.col("v_label")) & (F.col("embedding") == F.col("v_embedding")), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
