"""Near-duplicate documents by a chosen-path set similarity join (operator 5).

A document is the set of its 5-word shingles; two are linked when the Jaccard
similarity of their sets is at least 0.75, decided on the full sets.  Documents
with equal sets are one class from the start.

Every class has a sketch of minwise tokens.  Each of TREES independent trees
branches the classes by one token at its root, so a node holds the classes that
share it.  Nodes of at most LIMIT classes are compared exhaustively.  Larger
ones branch again, each class into BRANCHES children by further tokens that the
node's path chooses, until they are small, tight (most classes resemble the
node's first) or MAX_DEPTH deep.  A pair at the threshold shares a root's token
with probability 0.75 and stays together at a later branching with 1 - 0.25^2, so
at depth d it escapes 12 trees with probability (1 - 0.75 x 0.9375^d)^12: 6e-8 at
the root, 1e-5 at depth 3, the last.  Nodes are pairs of numbers until classes
meet; sketches join them only then.

A node that is still large and whose classes mostly lie in one component is
compared in blocks, the few outside against all.  Where more than LIMIT lie
outside (texts of one template that are alike but not linked), blocks would be all
pairs; its classes are split anew by the rarest shingles of their full sets
(``shared_prefixes``), which loses no link.

Comparison has two rounds, so that groups of copies are never expanded into
pairs.  The first proposes, in each node, links to leaders, where tokens make a
link likely; these are verified and give components.  The second looks at every
pair of a node whose ends are still in different components and marks both ends
if AGREE of 256 tokens are equal (almost five standard deviations below the
threshold).  The marked classes of a node then meet with their full sets (in
blocks of at most SHINGLES shingles, every two blocks), all intersections are
counted at once, and each class is tied to the least one it reaches: a task
returns at most a row a class, never the pairs.

Null text or text without words: empty set, linked with nothing, its own
component.  Repeated rows: one class.  Null doc_id: takes part; a component's id
is its least doc_id that is not null (null if there is none).  An empty table
gives no rows.  Other columns are not read; ``deduplicate`` passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import column_values, documents, ready, stored
from stockflow.llm.components import components
from stockflow.llm.words import mix, shingle_sets
from stockflow.operators.joins import bounded_broadcast

SHINGLE = 5
PERCENT = 75
TOKENS, TREES, BRANCHES = 256, 12, 2
LIMIT, MAX_DEPTH = 512, 3
AGREE = 159
SHINGLES = 1 << 19   # of full sets in a block of a node that is compared exactly
COLUMNS = 4096   # shingles at a time when a node's intersections are counted
LIKELY = 184   # equal tokens that make a class follow a leader, and a link worth trying first
_RNG = np.random.default_rng(5)
_A = _RNG.integers(1, 1 << 63, TREES + TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, TREES + TOKENS, dtype=np.uint64)


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Minwise tokens of non-empty sets: sets x TREES (32 bits, one for each
    tree's root) and sets x TOKENS (8 bits, to branch inside a node and to compare)."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    roots, tokens = np.empty((len(sets), TREES), dtype="<u4"), np.empty((len(sets), TOKENS), dtype=np.uint8)
    for k in range(TREES + TOKENS):
        least = np.minimum.reduceat((flat * _A[k] + _B[k]) >> np.uint64(32), starts)
        if k < TREES:
            roots[:, k] = least
        else:
            tokens[:, k - TREES] = mix(least) >> np.uint64(56)
    return roots, tokens


def _fingerprints(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """128 bits that depend on a set alone."""
    return [(int(mix(s).sum(dtype=np.uint64).view(np.int64)),
             int(mix(s * _A[0] + np.uint64(len(s))).sum(dtype=np.uint64).view(np.int64))) for s in sets]


def classes(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n, cls, roots, tokens): set size, class key (null: empty set) and sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(column_values(batch, "text"), size)
            full = [k for k, s in enumerate(sets) if len(s)]
            prints = dict(zip(full, _fingerprints([sets[k] for k in full]), strict=True))
            drawn = sketches([sets[k] for k in full]) if full else ([], [])
            place = np.full(len(sets), -1)
            place[full] = np.arange(len(full))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array(list(map(len, sets)), pa.int64()),
                 *[pa.array([prints[k][j] if k in prints else None for k in range(len(sets))], pa.int64()) for j in (0, 1)],
                 *[pa.array([rows[p].tobytes() if p >= 0 else None for p in place], pa.binary()) for rows in drawn]],
                names=["doc_id", "n", "f1", "f2", "roots", "tokens"])

    found = documents(docs).mapInArrow(run, "doc_id long, n long, f1 long, f2 long, roots binary, tokens binary")
    key = F.when(F.col("f1").isNotNull(), F.xxhash64("f1", "f2", "n"))
    return found.select("doc_id", "n", key.alias("cls"), "roots", "tokens")


def _nodes(rows: DataFrame, column: str, width: int, positions: Column) -> DataFrame:
    """(node, cls): each class under the token at each of ``positions``; nodes of
    one class are gone, the others have their size and least class."""
    token = F.substr(F.col(column), F.col("p") * width + 1, F.lit(width))
    below = rows.withColumn("p", F.explode(positions)).select(F.xxhash64("node", "p", token).alias("node"), "cls")
    below = stored(below, "below")   # pairs of numbers, read twice
    sizes = below.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("first")).where("size > 1")
    return stored(below.join(sizes, "node"), "nodes")


def leaves(reps: DataFrame) -> DataFrame:
    """(node, cls, size, first): the classes of all nodes to compare."""
    top = reps.withColumn("node", F.lit(0).cast("long"))
    rows = _nodes(top, "roots", 4, F.sequence(F.lit(0), F.lit(TREES - 1)))
    out = rows.where(F.col("size") <= LIMIT)
    for _ in range(MAX_DEPTH):
        big = rows.where(F.col("size") > LIMIT)
        if big.isEmpty():
            return out
        big = stored(big.join(reps.select("cls", "tokens"), "cls"), "big")
        heads = big.where("cls = first").select("node", F.col("tokens").alias("head"))
        # Equal tokens with the node's first class, over the last 16.
        token = lambda c, k: F.substr(F.col(c), F.lit(k + 1), F.lit(1))
        same = sum((token("tokens", k) == token("head", k)).cast("int") for k in range(TOKENS - 16, TOKENS))
        tight = big.join(heads, "node").groupBy("node").agg(F.avg((same >= 10).cast("int")).alias("tight"))
        tight = stored(tight, "tight")
        out = out.unionByName(big.join(tight.where("tight >= 0.5"), "node", "left_semi").select(*rows.columns))
        loose = big.join(tight.where("tight < 0.5"), "node", "left_semi")
        step = [F.pmod(F.xxhash64("node", F.lit(b)), F.lit(TOKENS)).cast("int") for b in range(BRANCHES)]
        rows = _nodes(loose, "tokens", 1, F.array_distinct(F.array(*step)))
        out = out.unionByName(rows.where(F.col("size") <= LIMIT))
    return out.unionByName(rows.where(F.col("size") > LIMIT))


def _blocked(rows: DataFrame) -> DataFrame:
    """Large nodes in blocks of about LIMIT classes, each with the node's first."""
    n = F.ceil(F.col("size") / LIMIT).cast("int")
    own = F.pmod(F.xxhash64("cls"), n).cast("int")
    place = F.when(n <= 1, F.array(F.lit(0))).when(F.col("cls") == F.col("first"), F.sequence(F.lit(0), n - 1)).otherwise(F.array(own))
    return rows.withColumn("block", F.explode(place)).select(F.xxhash64("node", "block").alias("node"), "cls")


def _compare(rows: DataFrame, reps: DataFrame, roots: bool) -> DataFrame:
    """Inside nodes: proposed links (a, b) to leaders, or in the second round
    (``rows`` have a root) the marked classes as (node, cls).  A node is small,
    so a task holds one at a time."""
    def links(node: int, cls: np.ndarray, t: np.ndarray, root: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if root is not None:
            marked = np.zeros(len(cls), dtype=bool)
            for k in range(len(cls) - 1):
                other = k + 1 + np.flatnonzero(root[k + 1:] != root[k])
                hit = other[(t[other] == t[k]).sum(axis=1) >= AGREE]
                marked[hit] = True
                marked[k] |= len(hit) > 0
            yield np.full(marked.sum(), node), cls[marked]
        else:
            left = np.arange(len(cls))
            while len(left) > 1:
                lead, left = left[0], left[1:]
                likely = (t[left] == t[lead]).sum(axis=1) >= LIKELY
                yield np.full(likely.sum(), cls[lead]), cls[left[likely]]
                left = left[~likely]

    def nodes(node: np.ndarray, cls: np.ndarray, t: np.ndarray, root: np.ndarray | None) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        size = np.diff(np.append(cuts, len(node)))
        two = cuts[size == 2]
        fit = two[(t[two] == t[two + 1]).sum(axis=1) >= (LIKELY if root is None else AGREE)] if len(two) else two
        if root is not None and len(fit):
            fit = fit[root[fit] != root[fit + 1]]
        if root is None:
            found = [(cls[fit], cls[fit + 1])]
        else:
            found = [(np.repeat(node[fit], 2), np.column_stack((cls[fit], cls[fit + 1])).ravel())]
        for s, n in zip(cuts[size > 2], size[size > 2], strict=True):
            found += links(node[s], cls[s:s + n], t[s:s + n], None if root is None else root[s:s + n])
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                   np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint8).reshape(-1, TOKENS),
                   batch.column(3).to_numpy() if roots else None]
            if held is not None:
                new = [None if x is None else np.concatenate((h, x)) for h, x in zip(held, new, strict=True)]
            last = int(np.searchsorted(new[0], new[0][-1]))   # the last node may go on in the next batch
            held = [None if x is None else x[last:] for x in new]
            if last:
                yield nodes(*[None if x is None else x[:last] for x in new])
        if held is not None:
            yield nodes(*held)

    columns = ["node", "cls", "tokens", *(["root"] if roots else [])]
    rows = rows.join(reps.select("cls", "tokens"), "cls")
    out = rows.select(*columns).repartition("node").sortWithinPartitions("node", "cls").mapInArrow(run, "a long, b long")
    if roots:
        return out.select(F.col("a").alias("node"), F.col("b").alias("cls"))
    return out.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _ties(members: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the least index it reaches over links between the sets."""
    size, flat = np.array(list(map(len, members))), np.concatenate(members)
    owner = np.repeat(np.arange(len(members)), size)
    _, column, uses = np.unique(flat, return_inverse=True, return_counts=True)
    shared = uses[column] > 1   # a shingle of one set adds to no intersection
    _, column = np.unique(column[shared], return_inverse=True)
    owner, order = owner[shared], np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(members), len(members)), dtype=np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, z = np.searchsorted(column, (first, first + COLUMNS))
        block = np.zeros((len(members), COLUMNS), dtype=np.float32)
        block[owner[a:z], column[a:z] - first] = 1
        both += block @ block.T
    both = both.astype(np.int64)
    linked = 100 * both >= percent * (size[:, None] + size - both)
    np.fill_diagonal(linked, True)
    least = np.arange(len(members))
    while True:
        after = np.where(linked, least, len(members)).min(axis=1)
        if (after == least).all():
            return least
        least = after


def exact(marked: DataFrame, members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) ties among the marked classes of each node, on their full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, []

        def tied() -> pa.RecordBatch:
            least = _ties([np.frombuffer(m, dtype=np.uint64) for _, m in held], percent)
            rows = [(held[k][0], held[j][0]) for k, j in enumerate(least) if k != j]
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in (0, 1)], names=["a", "b"])

        for batch in batches:
            for n, c, m in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if n != node and held:
                    yield tied()
                    held = []
                node = n
                held.append((c, m))
        if held:
            yield tied()

    # Nodes whose sets are long meet block by block.
    size = members.select("cls", (F.length("members") / 8).cast("long").alias("n"))
    sized = marked.join(size, "cls")
    blocks = sized.groupBy("node").agg(F.ceil(F.sum("n") / SHINGLES).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    met = (sized.join(blocks, "node").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "cls").distinct())
    rows = met.join(members, "cls").select("node", "cls", "members")
    return rows.repartition("node").sortWithinPartitions("node", "cls").mapInArrow(run, "a long, b long").distinct()


def full_sets(docs: DataFrame, reps: DataFrame, ends: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(cls, members): the sorted shingle hashes of the classes in ``ends``."""
    wanted = stored(reps.join(ends, "cls").select("cls", "rep", F.col("rep").isNull().alias("no_id")), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shingle_sets(column_values(batch, "text"), size)
            prints = [p if len(s) else (None, None) for p, s in zip(_fingerprints(found), found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([p[j] for p in prints], pa.int64()) for j in (0, 1)],
                 pa.array(list(map(len, found)), pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())],
                names=["f1", "f2", "n", "members"])

    # Texts of representatives only: by id, or all without an id if one of those is meant.
    ids = wanted.where("not no_id").select(F.col("rep").alias("doc_id")).distinct()
    d = documents(docs)
    texts = d.join(bounded_broadcast(ids), "doc_id", "left_semi").select("text")
    if not wanted.where("no_id").isEmpty():
        texts = texts.unionByName(d.where("doc_id is null").select("text"))
    members = (texts.mapInArrow(sets, "f1 long, f2 long, n long, members binary")
               .select(F.xxhash64("f1", "f2", "n").alias("cls"), "members").dropDuplicates(["cls"]))
    return stored(members.join(wanted.select("cls"), "cls", "left_semi"), "sets")


def verified(docs: DataFrame, reps: DataFrame, proposed: DataFrame, percent: int = PERCENT,
             size: int = SHINGLE) -> DataFrame:
    """The proposed links (a, b) whose full sets pass."""
    ends = proposed.select(F.col("a").alias("cls")).union(proposed.select(F.col("b").alias("cls"))).distinct()
    members = full_sets(docs, reps, ends, size)


    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok)], names=["a", "b", "ok"])

    first = proposed.join(members.select(F.col("cls").alias("b"), F.col("members").alias("y")), "b")
    full = first.join(members.select(F.col("cls").alias("a"), F.col("members").alias("x")), "a").select("a", "b", "x", "y")
    return stored(full.mapInArrow(judge, "a long, b long, ok boolean").where("ok").select("a", "b"), "links")


def link(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    ready(docs.sparkSession)
    found = stored(classes(docs, size), "classes")
    reps = stored(found.where("cls is not null").groupBy("cls")
                  .agg(F.min("doc_id").alias("rep"), F.first("roots").alias("roots"), F.first("tokens").alias("tokens")), "reps")
    nodes = stored(leaves(reps), "leaves")
    proposed = stored(_compare(_blocked(nodes), reps, roots=False), "proposed")
    links = verified(docs, reps, proposed, percent, size)
    roots = stored(components(links), "roots")

    # Second round: nodes that still hold several components.
    rooted = (nodes.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
              .withColumn("root", F.coalesce("root", "cls")))
    mixed = rooted.groupBy("node").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("node")
    rooted = stored(rooted.join(mixed, "node", "left_semi").select("node", "cls", "size", "root"), "mixed")
    crowded = stored(_crowded(rooted), "crowded")
    if not crowded.isEmpty():
        crowd = stored(rooted.join(crowded, "node", "left_semi").select("cls", "root").distinct(), "crowd")
        lists = shared_prefixes(crowd, full_sets(docs, reps, crowd.select("cls"), size), percent)
        rooted = rooted.join(crowded, "node", "left_anti").unionByName(lists)
    marked = _once(stored(_compare(_across(rooted), reps, roots=True), "marked"))
    if not marked.isEmpty():
        ties = exact(marked, full_sets(docs, reps, marked.select("cls").distinct(), size), percent)
        roots = stored(components(links.unionByName(ties)), "roots")

    by_class = reps.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    ids = by_class.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_class = by_class.join(ids, "root").select("cls", "component_id")
    full = found.where("cls is not null").select("doc_id", "n", "cls").join(by_class, "cls")
    empty = found.where("cls is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return (full.select("doc_id", "n", "component_id").unionByName(empty)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def _commonest(large: DataFrame) -> DataFrame:
    """(node, main, all, most): the commonest component of each node, its classes and that component's."""
    counts = large.groupBy("node", "root").agg(F.count(F.lit(1)).alias("c"))
    return counts.groupBy("node").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("all"), F.max("c").alias("most"))


def _crowded(rooted: DataFrame) -> DataFrame:
    """(node): the large nodes with more than LIMIT classes outside their commonest component."""
    return _commonest(rooted.where(F.col("size") > LIMIT)).where(F.col("all") - F.col("most") > LIMIT).select("node")


def _once(nodes: DataFrame) -> DataFrame:
    """Of the nodes (node, cls, ...) that hold the same classes, one."""
    held = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("held"), F.bit_xor(F.xxhash64("cls")).alias("print"))
    return nodes.join(held.groupBy("held", "print").agg(F.min("node").alias("node")).select("node"), "node", "left_semi")


def shared_prefixes(crowd: DataFrame, members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, cls, size, root): the classes of ``crowd`` (cls, root) by the rare
    shingles they share, so that any two linked ones of different components meet.

    With the shingles of every set in one order, rarest first, the first shingle that
    two linked sets share leaves either enough after it for the overlap, and the
    smaller set enough for a partner as large as itself.  So a shingle's list needs a
    set only up to that place, and only lists where such a smaller set stands are
    nodes.  Sets of one template share none but its common shingles, which come last:
    without links their rows grow with the shingles, not with the pairs.  Shingles of
    one class only count as places."""
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = np.frombuffer(m, dtype=np.int64)
                for k in range(0, len(held), SHINGLES):
                    part = held[k:k + SHINGLES]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), c)), pa.array(part), pa.array(np.full(len(part), len(held)))],
                                                     names=["cls", "shingle", "n"])

    rows = members.select("cls", "members").mapInArrow(shingles, "cls long, shingle long, n long")
    uses = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1")
    own = Window.partitionBy("cls")
    place = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("uses", "shingle")) - 1
    left = rows.join(uses, "shingle").select("cls", "shingle", "n", (F.col("n") - place).alias("left"))
    # The largest partner that what is left allows; the smaller set of a pair has one of its own size.
    left = left.withColumn("partner", F.floor(F.col("left") * (100 + percent) / percent + 1e-6).cast("long") - F.col("n"))
    left = left.where(100 * F.col("left") >= percent * F.col("n")).withColumn("smaller", F.col("partner") >= F.col("n"))
    left = stored(left.join(crowd, "cls").select("cls", "root", "shingle", "n", "partner", "smaller"), "prefixes")
    lists = (left.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(F.when(F.col("smaller"), F.col("n"))).alias("least"),
                                         F.max(F.when(F.col("smaller"), F.col("partner"))).alias("most"))
             .where("lo <> hi and least is not null").select("shingle", "least", "most"))
    fit = F.col("smaller") | ((F.col("partner") >= F.col("least")) & (F.col("n") <= F.col("most")))
    nodes = stored(left.join(lists, "shingle").where(fit).select(F.col("shingle").alias("node"), "cls", "root"), "lists")
    sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    return _once(nodes).join(sizes.where("lo <> hi").select("node", "size"), "node").select(F.xxhash64("node").alias("node"), "cls", "size", "root")


def _across(rooted: DataFrame) -> DataFrame:
    """Nodes for the second round.  A large node meets block by block: the
    classes outside its commonest component (the few) against all of it."""
    small = rooted.where(F.col("size") <= LIMIT).select("node", "cls", "root")
    large = rooted.where(F.col("size") > LIMIT)
    large = (large.join(_commonest(large), "node")
             .withColumn("few", F.ceil((F.col("all") - F.col("most")) / LIMIT).cast("int"))
             .withColumn("blocks", F.ceil(F.col("all") / LIMIT).cast("int")))
    block, part = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("cls"), F.col("few")).cast("int")
    everyone = large.withColumn("i", block).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("few") - 1)))
    outside = (large.where("root <> main").withColumn("j", part)
               .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    met = everyone.unionByName(outside).select(F.xxhash64("node", "i", "j").alias("node"), "cls", "root")
    return small.unionByName(met.distinct())


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each group of near-duplicates (its least doc_id), all columns
    kept.  Rows without an id stay.  An id on several rows stays if it leads a
    group, once for each of its texts."""
    ready(docs.sparkSession)
    row, key = F.struct(*docs.columns), F.col("row.doc_id").cast("long")   # other columns may have any name
    rows = docs.select(row.alias("row"))
    linked = stored(link(docs).where("doc_id is not null").groupBy("doc_id")
                    .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")), "kept")
    gone = bounded_broadcast(linked.where("not kept").select("doc_id"))
    left = rows.join(gone, key == gone["doc_id"], "left_anti")
    several = stored(linked.where("kept and rows > 1").select("doc_id"), "several")
    if not several.isEmpty():
        several = bounded_broadcast(several)
        again = (left.join(several, key == several["doc_id"], "left_semi").groupBy("row.doc_id", "row.text")
                 .agg(F.first("row").alias("row")).select("row"))
        left = left.join(several, key == several["doc_id"], "left_anti").unionByName(again)
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
