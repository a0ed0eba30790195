"""Near-duplicate detection with SetSketch registers.

A document's set holds its distinct shingles of `shingle` words. Two documents are linked if
100 * |A n B| >= percent * |A u B|; linked documents and those reachable form a component.

1. Sketch. `registers` registers, each the exponentially spaced, truncated minimum of an
   exponential hash over the set: K = floor(1 - log_b(min h)), kept in 0..q+1. Registers of
   a union are the greater ones of its parts. Documents of equal sets form one node.
2. Bands of `band` registers each deal the nodes to buckets. Linked nodes miss each other in
   all bands with probability (1 - J^band)^(registers/band), about 7e-7 for
   (J, band) = (0.85, 6) as well as (0.8, 5) of 180 registers.
3. Star round: every node is compared with the smallest node of each of its buckets. What
   is linked forms the first components; a bucket of near copies shrinks to one so.
4. Cross round: in buckets that still hold several components, nodes outside the largest
   one are compared with all members of other components, sketch against sketch. A pair
   passes unless the joint likelihood of J (given both set sizes) tells that a link is out
   of the question. Nodes that passing pairs connect make a group.
5. Verification, after either round: a group's nodes meet in cells of bounded size, with
   their whole texts, and passing pairs of different components are checked on the full
   sets, likeliest first, skipping what is connected by then. A text travels to its cells,
   never along with pairs, and only links leave a cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, only, ship_package, stored, table, tasks_for, text_or_empty
from .components import connected
from .wordcodes import mixed, texts_as_words, window_codes, word_codes

BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2      # b, a and q of the two-byte registers
SLACK = 12.0                                       # log likelihood by which a link must be ruled out
CELL = 512                                         # nodes verified or compared together
CELL_SHINGLES = 1 << 20                            # and shingles of their texts, about
TASK_ROWS = 1 << 13                                # nodes verified by a task, about
SKETCH_ROWS = 1 << 15                              # rows with registers written by a task, about
NO_ID = -(1 << 62)                                 # join key of rows without an id


@dataclass(frozen=True)
class Rule:
    shingle: int = 5
    percent: int = 80
    registers: int = 180
    band: int = 5


# -- sets and sketches -----------------------------------------------------

def shingle_sets(texts: list[str], shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, others, bounds): the distinct shingle codes of each text, ascending, one after the
    other, and beside each its second, independent code. A text of fewer words is one shingle,
    the whole sequence; one without words has none."""
    data, _, _, first = texts_as_words([t.encode().lower() for t in texts])             # bytes: A-Z only
    words, again = word_codes(data)
    codes, seconds = window_codes(words, shingle), window_codes(again, shingle)
    sets, others = [], []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= shingle:
            mine, at = np.unique(codes[a:b - shingle + 1], return_index=True)
            sets.append(mine)
            others.append(seconds[a:b - shingle + 1][at])
        else:
            for out, of in ((sets, words), (others, again)):
                out.append(window_codes(of[a:b], b - a, salt=b - a) if b > a else np.zeros(0, np.uint64))
    return np.concatenate([*sets, np.zeros(0, np.uint64)]), np.concatenate([*others, np.zeros(0, np.uint64)]), np.cumsum([0, *map(len, sets)])


def signatures(codes: np.ndarray, others: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers per set, one from each of the independent codes of its shingles."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(c, salt), dtype=np.uint64)]) for c, salt in ((codes, 31), (others, 32))]
    a, b = ((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums)
    return a, b


def register_values(codes: np.ndarray, bounds: np.ndarray, registers: int) -> np.ndarray:
    """SetSketch registers, a row per set; an empty set has zeros."""
    out = np.zeros((len(bounds) - 1, registers), "<u2")
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    # One hash per register: multiplying alone would leave the order of different registers
    # dependent, so the product is folded and multiplied again.
    factor = np.random.default_rng(85).integers(0, 1 << 31, (2, registers), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    x = (codes >> np.uint64(32)).astype(np.uint32)
    least, product, high = np.empty((registers, len(full)), np.uint32), np.empty_like(x), np.empty_like(x)
    for i in range(registers):
        np.multiply(x, factor[0, i], out=product)
        np.right_shift(product, np.uint32(15), out=high)
        np.bitwise_xor(product, high, out=product)
        np.multiply(product, factor[1, i], out=product)
        np.minimum.reduceat(product, bounds[:-1][full], out=least[i])
    exponential = -np.log1p(-(least.T + 0.5) / 2.0**32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP + 1)
    return out


def band_codes(registers: np.ndarray, band: int) -> np.ndarray:
    """A 64-bit code per row and band."""
    n, m = registers.shape
    part = registers.reshape(n, m // band, band).astype(np.uint64)
    code = np.zeros((n, m // band), np.uint64)
    for i in range(band):
        code = mixed(code + part[:, :, i], salt=i)
    return mixed(code + np.arange(m // band, dtype=np.uint64), salt=band)


def _order_chance(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 1e-12, 1 - 1e-12) * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(more, less, same, share, j):
    """Of J = j, given how many registers of U are greater than, less than and equal to V's,
    and U's share of |U| + |V|."""
    up, down = _order_chance(share - (1 - share) * j), _order_chance((1 - share) - share * j)
    return more * np.log(up) + less * np.log(down) + same * np.log(np.maximum(1 - up - down, 1e-12))


def passing(a: np.ndarray, b: np.ndarray, size_a, size_b, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(passes, estimate of J) for rows of registers: false only where the sizes or the joint
    likelihood rule a link out (the estimate is then left at 0)."""
    a, b = np.broadcast_arrays(a, b)
    size_a, size_b = (np.broadcast_to(np.asarray(s, float), len(a)) for s in (size_a, size_b))
    ok, estimate = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b), np.zeros(len(a))
    # Registers are equal with probability J at least; 0.3 below the limit the likelihood leaves no doubt.
    near = np.flatnonzero(ok)
    same = (a[near] == b[near]).sum(axis=1)
    ok[near] = same >= (percent / 100 - 0.3) * a.shape[1]
    near, same = near[ok[near]], same[ok[near]]
    if len(near):
        less = (a[near] < b[near]).sum(axis=1)
        more = a.shape[1] - less - same
        share = size_a[near] / (size_a[near] + size_b[near])
        limit = np.minimum(share, 1 - share) / np.maximum(share, 1 - share)
        grid = np.linspace(0.0, 1.0, 65)[:, None] * limit[None, :]
        value = log_likelihood(more, less, same, share, grid)
        best, each = value.argmax(axis=0), np.arange(len(near))
        estimate[near] = grid[best, each]
        at_link = log_likelihood(more, less, same, share, np.minimum(percent / 100, limit))
        ok[near] = (estimate[near] >= percent / 100) | (value[best, each] - at_link <= SLACK)
    return ok, estimate


def sketches(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, n, set_a, set_b, registers) per row: set size, 128-bit signature of
    the set, sketch."""
    src = only(docs, id_col, text_col).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))
    id_type = src.schema["id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _parts(batch):
                codes, others, bounds = shingle_sets(texts, rule.shingle)
                a, b = signatures(codes, others, bounds)
                rows = register_values(codes, bounds, rule.registers)
                yield pa.RecordBatch.from_arrays([part["id"], part["text_hash"], pa.array(np.diff(bounds)), pa.array(a), pa.array(b),
                                                  pa.array([r.tobytes() for r in rows], pa.binary())],
                                                 ["id", "text_hash", "n", "set_a", "set_b", "registers"])

    return map_batches(src, sketch, f"id {id_type}, text_hash long, n long, set_a long, set_b long, registers binary")


def _parts(batch: pa.RecordBatch, rows: int = 256, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch of about `size` bytes of text."""
    ends = np.cumsum(pa.compute.binary_length(batch["text"]).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = min(first + rows, batch.num_rows, max(first + 1, int(np.searchsorted(ends, before + size, side="right"))))
        part = batch.slice(first, last - first)
        yield part, part["text"].to_pylist()
        first = last


# -- candidates ------------------------------------------------------------

def memberships(nodes: DataFrame, rule: Rule) -> DataFrame:
    """(bucket, node, hub) of all buckets of two nodes or more; the hub is the smallest node."""
    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code = band_codes(_registers(batch["registers"], rule.registers), rule.band).view(np.int64)
                node = np.repeat(batch["node"].to_numpy(zero_copy_only=False), code.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(code.ravel()), pa.array(node)], ["bucket", "node"])

    dealt = map_batches(nodes.select("node", "registers"), bands, "bucket long, node long")
    full = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("hub")).filter("size > 1")
    return dealt.join(full.select("bucket", "hub"), "bucket")


def _registers(column: pa.Array, m: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, m)


def star_seats(members: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Seats of the star round: each node whose sketch passes with the hub of a bucket
    takes a seat with that hub, about CELL nodes to a cell, the hub in each of them."""
    side = nodes.select("node", "n", "registers")
    pairs = (members.filter("node <> hub").select(F.col("node").alias("x"), F.col("hub").alias("y")).distinct()
             .join(side.toDF("x", "n_x", "r_x"), "x").join(side.toDF("y", "n_y", "r_y"), "y"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                ok, _ = passing(_registers(part["r_x"], rule.registers), _registers(part["r_y"], rule.registers),
                                part["n_x"].to_numpy(), part["n_y"].to_numpy(), rule.percent)
                yield pa.RecordBatch.from_arrays([part[c].filter(pa.array(ok)) for c in ("x", "y", "n_x")], ["x", "y", "n_x"])

    judged = map_batches(pairs.select("x", "y", "n_x", "r_x", "n_y", "r_y"), judge, "x long, y long, n_x long")
    passed = stored(judged.repartition(tasks_for(members, members.count())), "near-star")
    blocks = passed.groupBy("y").agg(_blocks(F.count(F.lit(1)), F.sum("n_x")).alias("blocks"))
    spokes = passed.join(blocks, "y").select(
        F.col("y").alias("team"), F.pmod(F.xxhash64("x"), F.col("blocks")).alias("i"), F.col("x").alias("node"), F.lit(False).alias("major"))
    hubs = spokes.select("team", "i").distinct().select("team", "i", F.col("team").alias("node"), F.lit(True).alias("major"))
    return (spokes.unionByName(hubs).coalesce(tasks_for(passed, 2 * passed.count()))
            .select("team", "i", F.lit(-1).cast("long").alias("j"), "node", F.col("node").alias("component"), "major", F.col("i").alias("block")))


def _blocks(nodes: Column, shingles: Column) -> Column:
    """Blocks of about CELL nodes and CELL_SHINGLES shingles."""
    return F.greatest(F.lit(1), F.ceil(nodes / CELL), F.ceil(shingles / CELL_SHINGLES)).cast("long")


def cross_seats(teams: DataFrame, components: DataFrame, nodes: DataFrame) -> DataFrame:
    """(team, i, j, node, component, major, block): seats of the members (team, node) of
    teams that hold several components.

    A team's members of its largest component (`major`) need no comparison with each other.
    The others go to blocks (see `_blocks`), and so do the majors. Cell (i, j) seats other
    blocks i <= j, or, for j < 0, other block i and major block -j; so a team of any size is
    spread over many cells, none of them above 2 * CELL nodes."""
    m = (teams.select("team", "node").join(components, "node", "left").join(nodes.select("node", "n"), "node")
         .select("team", "node", F.coalesce("component", "node").alias("component"), "n"))
    counts = m.groupBy("team", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("size"))
    several = (counts.groupBy("team").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("all"), F.sum("size").alias("all_size"),
                                          F.max(F.struct("n", "component", "size")).alias("most"))
               .filter("parts > 1")
               .select("team", F.col("most.component").alias("major_component"),
                       _blocks(F.col("most.n"), F.col("most.size")).alias("major_blocks"),
                       _blocks(F.col("all") - F.col("most.n"), F.col("all_size") - F.col("most.size")).alias("other_blocks")))
    m = m.drop("n")
    m = m.join(several, "team").withColumn("major", F.col("component") == F.col("major_component"))
    m = m.withColumn("block", F.pmod(F.xxhash64("node"), F.when(F.col("major"), F.col("major_blocks")).otherwise(F.col("other_blocks"))))
    others = F.sequence(F.lit(0).cast("long"), F.col("other_blocks") - 1)
    majors = F.sequence(F.lit(1).cast("long"), F.col("major_blocks"))
    cells = F.when(F.col("major"), F.transform(others, lambda i: F.struct(i.alias("i"), (-F.col("block") - 1).alias("j")))).otherwise(
        F.concat(F.transform(others, lambda k: F.struct(F.least(F.col("block"), k).alias("i"), F.greatest(F.col("block"), k).alias("j"))),
                 F.transform(majors, lambda k: F.struct(F.col("block").alias("i"), (-k).alias("j")))))
    return (m.select("team", "node", "component", "major", "block", F.explode(cells).alias("cell"))
            .select("team", "cell.i", "cell.j", "node", "component", "major", "block"))


class Cell:
    """The nodes of one cell, and the pairs of them that are to be looked at."""

    def __init__(self, rows: pa.Table, rule: Rule, bucket: bool = False):
        """`bucket`: the team is a bucket, and a pair counts in the first one that it shares."""
        self.rule = rule
        self.node, self.component, self.size = (rows[c].to_numpy() for c in ("node", "component", "n"))
        self.major, self.block = rows["major"].to_numpy(), rows["block"].to_numpy()
        self.registers = _registers(rows["registers"], rule.registers)
        self.i, self.j = rows["i"][0].as_py(), rows["j"][0].as_py()
        bands = band_codes(self.registers, rule.band) if bucket else np.zeros((len(self.node), 0), np.uint64)
        shared = np.flatnonzero((bands == bands[0]).all(axis=0)) if len(bands) else []
        self.earlier = np.ascontiguousarray(bands[:, :shared[0]]) if len(shared) else bands[:, :0]

    def passing(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(x, ys, estimates): indices of passing pairs of different components, each pair once."""
        for x in np.flatnonzero(~self.major):
            if self.j < 0:
                ys = np.flatnonzero(self.major)
            elif self.i == self.j:
                ys = np.flatnonzero(self.node > self.node[x])
            else:
                ys = np.flatnonzero(self.block != self.block[x]) if self.block[x] == self.i else np.zeros(0, np.int64)
            ys = ys[self.component[ys] != self.component[x]]
            ys = ys[~(self.earlier[ys] == self.earlier[x]).any(axis=1)]
            if len(ys):
                ok, estimate = passing(self.registers[ys], self.registers[x][None, :], self.size[ys], self.size[x], self.rule.percent)
                if ok.any():
                    yield x, ys[ok], estimate[ok]


_CELL = ("team", "i", "j")


def _tasks(seats: DataFrame) -> int:
    """Tasks for the cells of a stored table of seats: by their work, not by their few bytes."""
    return max(1, -(-seats.count() // TASK_ROWS))


def cross_groups(members: DataFrame, components: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): edges that connect the nodes of every passing pair of different components
    that shares a bucket, at most one per node and cell."""
    seats = cross_seats(members.select(F.col("bucket").alias("team"), "node"), components, nodes)
    seats = stored(seats.coalesce(tasks_for(seats, members.count(), SKETCH_ROWS)), "near-cross")
    tasks = _tasks(seats)
    rows = (seats.join(nodes.select("node", "n", "registers"), "node").select(*_CELL, "node", "component", "major", "block", "n", "registers")
            .repartition(tasks, *_CELL))

    def compare(rows: pa.Table) -> pa.Table:
        cell = Cell(rows, rule, bucket=True)
        label, met = np.arange(len(cell.node)), np.zeros(len(cell.node), bool)
        for x, ys, _ in cell.passing():
            met[x] = met[ys] = True
            old = np.unique(np.append(label[ys], label[x]))
            label[np.isin(label, old)] = old[0]
        edge = np.flatnonzero(met & (label != np.arange(len(label))))
        return pa.table({"a": pa.array(cell.node[edge], pa.int64()), "b": pa.array(cell.node[label[edge]], pa.int64())})

    edges = rows.groupBy(*_CELL).applyInArrow(compare, "a long, b long")
    return edges.repartition(tasks_for(edges, tasks * TASK_ROWS))       # a cell has fewer edges than seats


# -- verification ----------------------------------------------------------

def verified(seats: DataFrame, nodes: DataFrame, docs: DataFrame, rule: Rule, id_col: str, text_col: str,
             repeated: bool, slots: int = 1 << 18) -> DataFrame:
    """(a, b): links between nodes of different components that share a cell, enough of them
    to connect whatever the links of the cell connect. `seats` is a stored table; `repeated`
    tells whether an id stands with the same text in several rows."""
    guests = seats.join(nodes.select("node", "n", "set_a", "set_b", "key", F.col("first.text_hash").alias("text_hash"), "registers"), "node")
    guests = stored(guests.coalesce(tasks_for(guests, seats.count(), SKETCH_ROWS)), "near-guests")

    # Texts of the nodes in question, one for each id and text: rows that share an id, or have
    # none, are told apart by the text's hash; copies of a whole row, if the table has any, are
    # reduced before the shuffle. The slots of both (at most `slots` numbers, however large the tables) thin the
    # documents out first; the join decides.
    slot = F.pmod(F.xxhash64("key", "text_hash"), F.lit(slots))
    asked = guests.select(slot.alias("slot")).distinct()
    texts = (only(docs, id_col, text_col)
             .select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), text_or_empty(text_col).alias("text"))
             .withColumn("text_hash", F.xxhash64("text"))
             .withColumn("slot", slot).join(F.broadcast(asked), "slot", "left_semi").select("key", "text_hash", "text"))
    if repeated:
        texts = texts.groupBy("key", "text_hash").agg(F.max("text").alias("text"))
    tasks = _tasks(guests)
    seated = (guests.join(texts, ["key", "text_hash"])
              .select(*_CELL, "node", "component", "major", "block", "n", "set_a", "set_b", "registers", "text")
              .repartition(tasks, *_CELL))

    def check(rows: pa.Table) -> pa.Table:
        # Hashes of texts may be equal: the text of a node is the one with the node's signature.
        own, sets = [], []
        for at in range(0, rows.num_rows, 256):
            part = rows.slice(at, 256)
            codes, others, bounds = shingle_sets(part["text"].to_pylist(), rule.shingle)
            a, b = signatures(codes, others, bounds)
            for i in np.flatnonzero((a == part["set_a"].to_numpy()) & (b == part["set_b"].to_numpy())).tolist():
                own.append(at + i)
                sets.append(codes[bounds[i]:bounds[i + 1]])
        _, first = np.unique(rows["node"].to_numpy()[own], return_index=True)      # repeated rows of a node are alike
        cell, sets = Cell(rows.drop_columns(["text"]).take([own[i] for i in first]), rule), [sets[i] for i in first]
        pairs = [(estimate[k], x, y) for x, ys, estimate in cell.passing() for k, y in enumerate(ys.tolist())]
        root = {c: c for c in cell.component.tolist()}
        component = cell.component.tolist()

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        links = []
        for _, x, y in sorted(pairs, key=lambda p: -p[0]):
            a, b = find(component[x]), find(component[y])
            if a != b and _linked(sets[x], sets[y], rule.percent):
                root[max(a, b)] = min(a, b)
                links.append((int(cell.node[x]), int(cell.node[y])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    links = seated.groupBy(*_CELL).applyInArrow(check, "a long, b long")
    return links.repartition(tasks_for(links, tasks * TASK_ROWS))       # a cell has fewer links than guests


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, great = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(great):
        return False
    at = np.searchsorted(great, small)
    both = int((great[np.minimum(at, len(great) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


# -- the whole -------------------------------------------------------------

def near_dedup(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id reachable), kept
    (id = component_id), and for filters: text_hash (xxhash64 of the text), stays.

    Null and blank texts have an empty set and are linked with nothing; equal sets are
    linked. A null id is never the smallest unless its component has no other; such a
    component's rows have component_id null and are kept. Repeated ids are rows of their
    own; `stays` is true for one (id, text) of each component, also where its id repeats.
    An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    rows = stored(sketches(docs, rule, id_col, text_col), "near-sketches")
    classes = (rows.filter("n > 0").groupBy("set_a", "set_b", "n")
               .agg(F.min(_first()).alias("first"), F.count(F.lit(1)).alias("copies"), F.min("registers").alias("registers")))
    n_rows = rows.count()
    classes = classes.coalesce(tasks_for(rows, n_rows, SKETCH_ROWS))
    nodes = stored(classes.select(
        F.monotonically_increasing_id().alias("node"), "set_a", "set_b", "n", "first", "copies",
        F.coalesce(F.col("first.id").cast("long"), F.lit(NO_ID)).alias("key"), "registers"), "near-nodes")
    members = memberships(nodes, rule)
    members = stored(members.coalesce(tasks_for(rows, n_rows * (rule.registers // rule.band))), "near-members")

    same = rows.filter("n > 0").groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    repeated = not same.isEmpty()
    seats = stored(star_seats(members, nodes, rule), "near-seats")
    links = stored(verified(seats, nodes, docs, rule, id_col, text_col, repeated), "near-links")
    components = connected(links)
    groups = stored(cross_groups(members, components, nodes, rule), "near-groups")
    if not groups.isEmpty():
        teams = connected(groups).select(F.col("component").alias("team"), "node")
        seats = cross_seats(teams, components, nodes)       # a node is in one team
        seats = stored(seats.coalesce(tasks_for(seats, n_rows, SKETCH_ROWS)), "near-seats")
        more = stored(verified(seats, nodes, docs, rule, id_col, text_col, repeated), "near-links")
        components = connected(links.unionByName(more))

    joined = nodes.select("node", "set_a", "set_b", "first", "copies").join(components, "node", "left")
    smallest = (joined.filter("component is not null").groupBy("component").agg(F.min("first").alias("smallest")))
    # Rows that stand alone need no look-up.
    shared = (joined.filter("component is not null or copies > 1").join(smallest, "component", "left")
              .select("set_a", "set_b", F.coalesce("smallest", "first").alias("smallest")))
    shared = stored(shared.coalesce(tasks_for(rows, n_rows)), "near-shared")
    grouped = (F.col("n") > 0) & F.col("smallest").isNotNull()
    return (rows.drop("registers").join(shared, ["set_a", "set_b"], "left")
            .withColumn("component_id", F.when(grouped, F.col("smallest.id")).otherwise(F.col("id")))
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash",
                    F.when(grouped, F.col("smallest").eqNullSafe(_first())).otherwise(F.lit(True)).alias("stays")))


def _first():
    """Order within a component: null ids last, then the id, then the text's hash."""
    return F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("text_hash").alias("text_hash"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup(table(spark, sf_dir, "documents"), Rule(shingle=3, percent=85, band=6))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM pairs JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON e.x = reach.r)
SELECT reach.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id, reach.doc_id = min(r) AS kept
FROM reach LEFT JOIN n ON n.doc_id = reach.doc_id GROUP BY reach.doc_id
"""

QUERIES = {"op10_near_dedup": (op10_near_dedup, OP10_SQL)}
