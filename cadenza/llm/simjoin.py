"""Similarity join on word n-grams by chosen paths.

A document is the set of its five-word shingles; documents of equal sets are one representative.
A representative's 64 minhashes embed the set, so that two agree in a place with probability
their Jaccard similarity.  Every run puts the representatives into a tree of its own: the root
splits on one sampled place, every node that is too large on each place with a probability that
makes ``BRANCH`` children on average, and a child holds those that agree there.  Pairs at the
threshold survive a run with a probability that does not fall with the depth; dissimilar ones
part.  Runs repeat until the target recall is reached.

Small nodes are compared by brute force.  A node that stays nearly whole when it is split holds
mostly similar sets; it is compared in blocks of its members, so nothing is capped.  Pairs are
never rows: a task compares the members of its node, verifies candidate pairs on the exact
shingle sets, each pair in only one node, and returns per member the weight of its links and the
member that stands for its part.  Classes are the connected components of the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import KEY, fresh, mixed, row_key, ship, slices, whole_groups
from cadenza.session import stored

SHINGLE, THRESHOLD = 5, 0.8
PLACES, BRANCH, TARGET = 64, 1.5, 0.999
LIMIT, BLOCK, VISITORS, DENSE, DEPTH = 512, 256, 1024, 0.75, 16
# Estimates this far, in standard deviations, below the threshold are still verified.
SLACK = 5.0
CACHED_WORDS = 1 << 20
_SEED = 0x5EED


class _Words(dict):
    """Hash of each word seen by a task."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def _shingled(texts: list[str], words: _Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, with repeats, and where each text's begin.

    A text of fewer than ``n`` words is one shingle of all of them, one without words has none.
    """
    split = [t.lower().split() for t in texts]
    counts = np.array([len(w) for w in split], dtype=np.int64)
    flat = np.fromiter((words[w] for ws in split for w in ws), dtype=np.uint64, count=int(counts.sum()))
    edges = np.concatenate([[0], np.cumsum(counts)])
    shingles = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    starts = np.concatenate([[0], np.cumsum(shingles)])
    first = np.repeat(edges[:-1] - starts[:-1], shingles) + np.arange(starts[-1])
    size = np.repeat(np.minimum(counts, n), shingles)
    padded = np.concatenate([flat, np.zeros(n, dtype=np.uint64)])
    out = size.astype(np.uint64)
    for i in range(n):
        word = np.where(size > i, padded[first + i], np.uint64(0))
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + word)
    return out, starts


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * PLACES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(_SEED))
    return seeds[:PLACES] | np.uint64(1), seeds[PLACES:]


def _signatures(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, key columns, rid, signature): rid names the set, null for a document without words."""
    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *row_key(F.col("doc_id"), F.col("text")), F.col("text").cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (factors, terms) = _Words(), _coefficients()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                shingles, starts = _shingled(texts, words, n)
                some = np.flatnonzero(np.diff(starts))
                names: list[bytes | None] = [None] * len(texts)
                signatures: list[bytes | None] = [None] * len(texts)
                if len(some):
                    held = np.empty((len(some), PLACES), dtype=np.uint32)
                    for place in range(PLACES):
                        held[:, place] = np.minimum.reduceat(shingles * factors[place] + terms[place], starts[some]) >> np.uint64(32)
                    for row, text in enumerate(some.tolist()):
                        names[text] = xxhash.xxh3_128_digest(np.unique(shingles[starts[text] : starts[text + 1]]).tobytes())
                        signatures[text] = held[row].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[part.column(k) for k in KEY], pa.array(names, pa.binary()), pa.array(signatures, pa.binary())],
                    names=["doc_id", *KEY, "rid", "signature"],
                )

    return picked.mapInArrow(sign, "doc_id bigint, key_id bigint, key_null int, key_text bigint, rid binary, signature binary")


def survival(threshold: float = THRESHOLD, branch: float = BRANCH) -> float:
    """Probability that a pair at the threshold stays together down one run, at any depth."""
    mean, alive = threshold * branch, 1.0
    for _ in range(1000):
        alive = 1 - math.exp(-mean * alive)
    return threshold * alive


def branch_for(threshold: float) -> float:
    """Children of a split such that a pair at the threshold meets as often in them as one at ``THRESHOLD`` in ``BRANCH``."""
    if not 0 < threshold <= 1:
        raise ValueError("a threshold lies above 0 and is 1 at most")
    return BRANCH * THRESHOLD / threshold


def runs_for(threshold: float = THRESHOLD, target: float = TARGET, branch: float = BRANCH) -> int:
    """Runs after which a pair at the threshold has been found with probability ``target``; ValueError if ``PLACES`` are too few."""
    if not 0 < target < 1:
        raise ValueError("a target lies between 0 and 1")
    alive = survival(threshold, branch) if threshold * branch > 1 else 0.0
    runs = math.ceil(math.log(1 - target) / math.log(1 - alive)) if 0 < alive < 1 else PLACES + 1
    if runs > PLACES:
        raise ValueError(f"{PLACES} runs of {branch:g} children do not find pairs of similarity {threshold:g} with probability {target:g}")
    return runs


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures as rows; all are of one length."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(len(column), PLACES)


def _roots(representatives: DataFrame, runs: int) -> DataFrame:
    """(node, rid) of every run's first split."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(mixed(np.arange(PLACES, dtype=np.uint64) + np.uint64(_SEED)))[:runs]
        for batch in batches:
            if len(batch) == 0:
                continue
            held = _matrix(batch.column("signature"))[:, order].astype(np.uint64)
            nodes = mixed(held + (np.arange(1, len(order) + 1, dtype=np.uint64) << np.uint64(32)))
            rows = np.repeat(np.arange(len(batch)), len(order))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes.ravel().view(np.int64)), batch.column("rid").take(pa.array(rows))], names=["node", "rid"]
            )

    return representatives.select("rid", "signature").mapInArrow(split, "node bigint, rid binary")


def _children(members: DataFrame, branch: float) -> DataFrame:
    """(parent, node, rid): ``members`` (node, rid, signature) split on the places sampled for their node."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.arange(PLACES, dtype=np.uint64)
        bar = np.uint64(int(branch / PLACES * (1 << 32)))
        for batch in batches:
            if len(batch) == 0:
                continue
            parent = batch.column("node").to_numpy().view(np.uint64)
            chosen = mixed(parent[:, None] + (places + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32) < bar
            rows, place = np.nonzero(chosen)
            value = _matrix(batch.column("signature"))[rows, place].astype(np.uint64)
            nodes = mixed(mixed(parent[rows] ^ (place.astype(np.uint64) << np.uint64(32))) + value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(parent[rows].view(np.int64)), pa.array(nodes.view(np.int64)), batch.column("rid").take(pa.array(rows))],
                names=["parent", "node", "rid"],
            )

    return members.mapInArrow(split, "parent bigint, node bigint, rid binary")


def _leaves(representatives: DataFrame, runs: int, branch: float, limit: int) -> DataFrame:
    """(bucket, rid): all nodes small enough to compare, and the blocks of those that hold similar sets."""
    roots = stored(_roots(representatives, runs))
    sizes = roots.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(roots.join(sizes, "node"))
    found = members.where(F.col("size") <= limit).select(F.col("node").alias("bucket"), "rid")
    large = members.where(F.col("size") > limit).select("node", "rid", "size")
    if not large.isEmpty():
        alike, large = _alike(large, runs)
        found = found.unionByName(alike)
    depth = 1
    while not large.isEmpty():
        split = stored(_children(large.select("node", "rid").join(representatives.select("rid", "signature"), "rid").select("node", "rid", "signature"), branch))
        above = large.select(F.col("node").alias("parent"), F.col("size").alias("whole")).distinct()
        sizes = (
            split.groupBy("parent", "node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
            .join(above, "parent").select("node", "size", (F.col("size") >= DENSE * F.col("whole")).alias("dense"))
        )
        members = stored(split.select("node", "rid").join(sizes, "node"))
        found = found.unionByName(members.where(F.col("size") <= limit).select(F.col("node").alias("bucket"), "rid"))
        whole = (F.col("size") > limit) & (F.col("dense") if depth < DEPTH else F.lit(True))
        found = found.unionByName(_dense(members.where(whole)))
        large = members.where((F.col("size") > limit) & ~whole).select("node", "rid", "size")
        depth += 1
    return found


def _marked(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members`` with the least node each rid is in as its mark, and (node, mark, n).

    Runs find much the same nodes again; members of one mark are all in the node of that name.
    """
    marks = members.groupBy("rid").agg(F.min("node").alias("mark"))
    marked = stored(members.select("node", "rid", "size").join(marks, "rid"))
    return marked, stored(marked.groupBy("node", "mark").agg(F.count(F.lit(1)).alias("n")))


def _own_block(rows: DataFrame) -> DataFrame:
    blocks = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    return blocks.withColumn("own", F.pmod(F.xxhash64("rid", "node"), F.col("blocks")).cast("int"))


def _every_block():
    return F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))


def _paired(rows: DataFrame) -> DataFrame:
    """Buckets in which every two members of a node (node, rid, size) meet: two blocks of it each."""
    return _own_block(rows).select("node", "rid", "own", _every_block().alias("other")).select(
        F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "rid"
    )


def _visited(rows: DataFrame) -> DataFrame:
    """Buckets in which members of a node's most frequent mark meet those of other marks, and these each other.

    ``rows`` has (node, rid, size, marked, mark, most), ``marked`` counting the members of the most
    frequent mark.  The others are few: mostly one block of them meets every block of the rest.
    """
    visitors = F.col("size") - F.col("marked")
    blocks = {"blocks": F.ceil(F.col("marked") / BLOCK).cast("int"), "groups": F.ceil(visitors / VISITORS).cast("int")}
    dealt = rows.where(visitors > 0).withColumns(blocks)
    place = lambda n: F.pmod(F.xxhash64("rid", "node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    hosts = dealt.where("mark = most").select("node", "rid", place("blocks").alias("block"), every("groups").alias("group"))
    strangers = dealt.where("mark != most")
    guests = strangers.select("node", "rid", place("groups").alias("group"), every("blocks").alias("block"))
    met = hosts.unionByName(guests).select(F.xxhash64("node", "block", "group", F.lit(1)).alias("bucket"), "rid")
    among = _paired(strangers.where("groups > 1").select("node", "rid", visitors.alias("size")))
    return met.unionByName(among)


def _alike(large: DataFrame, runs: int) -> tuple[DataFrame, DataFrame]:
    """Buckets for the large first nodes of similar sets, and the other ones, still to be split.

    Of two members of one mark the share of runs in which they are together estimates their
    similarity.  Where splitting would make more rows of such members than there are, all of that
    mark are compared once, in blocks, and the nodes they fill compare only what else they hold.
    """
    marked, counts = _marked(large)
    n = F.col("n").cast("double")
    groups = counts.groupBy("mark").agg(F.sum(n * n).alias("squares"), F.max(F.when(F.col("node") == F.col("mark"), n)).alias("whole"))
    dense = stored(groups.where(F.col("squares") >= runs * (F.col("whole") / BRANCH) ** 2).select("mark", F.col("whole").cast("bigint").alias("size")))
    met = _paired(marked.where("node = mark").select("rid", "mark").join(dense, "mark").select(F.col("mark").alias("node"), "rid", "size"))
    frequent = counts.join(dense.select("mark"), "mark").groupBy("node").agg(
        F.max_by("mark", F.struct("n", "mark")).alias("most"), F.max("n").alias("marked")
    )
    filled = F.coalesce(2 * F.col("marked") >= F.col("size"), F.lit(False))
    dealt = stored(marked.join(frequent, "node", "left").withColumn("filled", filled))
    visits = _visited(dealt.where("filled").drop("filled"))
    return met.unionByName(visits), dealt.where("not filled").select("node", "rid", "size")


def _dense(members: DataFrame) -> DataFrame:
    """Buckets in which every two members of a dense node (node, rid, size) meet.

    A node whose most frequent mark is its own puts every two of its blocks together; in any other
    one the members of that mark have met.
    """
    marked, counts = _marked(members)
    frequent = counts.groupBy("node").agg(F.max_by("mark", F.struct("n", "mark")).alias("most"), F.max("n").alias("marked"))
    dealt = marked.join(frequent, "node")
    met = _paired(dealt.where("most = node").select("node", "rid", "size"))
    return met.unionByName(_visited(dealt.where("most != node")))


def _halved(representatives: DataFrame) -> DataFrame:
    """(rid, signature) with the low 16 bits of every place."""

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                low = _matrix(batch.column("signature")).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array([row.tobytes() for row in low], pa.binary())], names=["rid", "signature"])

    return representatives.select("rid", "signature").mapInArrow(halve, "rid binary, signature binary")


def _candidates(leaves: DataFrame, representatives: DataFrame, threshold: float) -> DataFrame:
    """(bucket, spot, rid, partners): in each bucket the pairs that may reach the threshold.

    ``partners`` holds the spots of later members.  A pair is left to the least bucket it has.
    """
    # Runs often part the same members: one bucket stands for all of equal membership.
    leaves = stored(leaves.distinct())
    alike = leaves.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("rid")).alias("x"), F.bit_xor(F.xxhash64("rid", F.lit(1))).alias("y")
    ).where("n > 1")
    kept = alike.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket")
    members = stored(leaves.join(kept, "bucket"))
    lists = members.groupBy("rid").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))
    # Half of each minhash is enough to tell places that agree from others.
    rows = members.join(lists, "rid").join(_halved(representatives), "rid")
    least = math.floor(PLACES * threshold - SLACK * math.sqrt(PLACES * threshold * (1 - threshold)))

    def compare(held: pa.RecordBatch) -> pa.RecordBatch | None:
        bucket = held.column("bucket")[0].as_py()
        places = np.frombuffer(b"".join(held.column("signature").to_pylist()), dtype=np.uint16).reshape(len(held), PLACES)
        n = len(places)
        agree = np.zeros((n, n), dtype=np.uint8)
        for place in range(PLACES):
            agree += places[:, place, None] == places[None, :, place]
        first, second = np.nonzero(np.triu(agree >= max(least, 1), 1))
        lists = [np.array(b, dtype=np.int64) for b in held.column("buckets").to_pylist()]
        earlier = [frozenset(b[b < bucket].tolist()) for b in lists]
        partners: list[list[int]] = [[] for _ in range(n)]
        used = set()
        for i, j in zip(first.tolist(), second.tolist(), strict=True):
            if earlier[i].isdisjoint(earlier[j]):
                partners[i].append(j)
                used.update((i, j))
        if not used:
            return None
        spots = np.array(sorted(used))
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket] * len(spots)), pa.array(spots, pa.int32()), held.column("rid").take(pa.array(spots)),
             pa.array([partners[i] for i in spots.tolist()], pa.list_(pa.int32()))],
            names=["bucket", "spot", "rid", "partners"],
        )

    return rows.select("bucket", "rid", "signature", "buckets").repartition("bucket").sortWithinPartitions("bucket", "rid").mapInArrow(
        _by_bucket(compare), "bucket bigint, spot int, rid binary, partners array<int>"
    )


def _by_bucket(work):
    """Call ``work`` with the rows of one bucket at a time; they lie together, a bucket is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, edges in whole_groups(batches, "bucket"):
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                done = work(block.slice(start, stop - start))
                if done is not None:
                    yield done

    return run


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(rid, shingles) of the representatives whose documents ``wanted`` (key columns, rid) names."""
    keyed = docs.select(*row_key(F.col("doc_id"), F.col("text")), F.col("text").cast("string").alias("text"))
    rows = keyed.join(wanted, list(KEY)).select("rid", "text")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                shingles, starts = _shingled(texts, words, n)
                sets = [np.unique(shingles[a:b]).view(np.int64) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([part.column("rid"), pa.ListArray.from_arrays(pa.array(offsets), values)], names=["rid", "shingles"])

    # Repeated rows of one document give its set once.
    return rows.dropDuplicates(["rid"]).mapInArrow(shingle, "rid binary, shingles array<bigint>")


def _verified(candidates: DataFrame, sets: DataFrame, weights: DataFrame, threshold: float) -> DataFrame:
    """(rid, links, root): per bucket and linked member the weight of its links and who stands for its part."""
    rows = candidates.join(sets, "rid").join(weights, "rid").select("bucket", "spot", "rid", "partners", "copies", "shingles")

    def verify(held: pa.RecordBatch) -> pa.RecordBatch | None:
        spots = held.column("spot").to_pylist()
        row_of = {spot: row for row, spot in enumerate(spots)}
        sets = [np.sort(s.values.to_numpy().view(np.uint64)) for s in held.column("shingles")]
        copies = held.column("copies").to_pylist()
        links, root = [0] * len(spots), list(range(len(spots)))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, partners in enumerate(held.column("partners").to_pylist()):
            for j in (row_of[p] for p in partners):
                a, b = sorted((sets[i], sets[j]), key=len)
                if len(a) < threshold * len(b) - 1e-9:
                    continue
                at = np.searchsorted(b, a)
                common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                if common >= threshold * (len(a) + len(b) - common) - 1e-9:
                    links[i] += copies[j]
                    links[j] += copies[i]
                    x, y = sorted((top(i), top(j)))
                    root[y] = x
        linked = [i for i, n in enumerate(links) if n]
        if not linked:
            return None
        rids = held.column("rid")
        return pa.RecordBatch.from_arrays(
            [rids.take(pa.array(linked)), pa.array([links[i] for i in linked], pa.int64()), rids.take(pa.array([top(i) for i in linked]))],
            names=["rid", "links", "root"],
        )

    return rows.repartition("bucket").sortWithinPartitions("bucket", "spot").mapInArrow(
        _by_bucket(verify), "rid binary, links bigint, root binary"
    )


def components(edges: DataFrame) -> DataFrame:
    """(rid, label): the least rid of each connected component of ``edges`` (rid, root).

    Labels spread to neighbours and then jump to their label's label, so paths halve every round.
    """
    edges = edges.where("rid != root")
    both = stored(edges.select("rid", F.col("root").alias("other")).unionByName(edges.select(F.col("root").alias("rid"), F.col("rid").alias("other"))).distinct())
    labels = stored(both.groupBy("rid").agg(F.least(F.min("other"), F.first("rid")).alias("label")))
    while True:
        heard = both.join(labels.select(F.col("rid").alias("other"), "label"), "other").groupBy("rid").agg(F.min("label").alias("heard"))
        near = labels.join(heard, "rid").select("rid", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        jump = labels.select(F.col("rid").alias("label"), F.col("label").alias("further"))
        new = stored(near.join(jump, "label", "left").select("rid", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        if new.where("label != old").isEmpty():
            return new.select("rid", "label")
        labels = new.select("rid", "label")


def similar(
    docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, target: float = TARGET, branch: float | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """(doc_id, key columns, rid, class_id, n_links, first): the class of every document.

    ``n_links`` counts the other documents of similarity at least ``threshold``, copies included.
    ``class_id`` is the least doc_id of the document's class, and ``first`` marks the row that class
    keeps: least doc_id, null ids last, equal ids by a hash of the text.  Words are what lies
    between white space, in lower case.  A document of fewer than ``shingle`` words is one shingle of all of
    them; one without words, as of null text, has no links and is a class of its own (rid null).
    Repeated rows are copies of each other.  An empty table gives no rows; other columns are not read.
    Splits grow wider as the threshold falls; where ``PLACES`` runs cannot reach ``target``, ValueError.
    """
    branch = branch_for(threshold) if branch is None else branch
    runs = runs_for(threshold, target, branch)
    signed = stored(_signatures(docs, shingle))
    order = F.struct("key_null", "key_id", "key_text")
    representatives = stored(
        signed.where("rid is not null").groupBy("rid").agg(
            F.first("signature").alias("signature"), F.min(order).alias("first"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies")
        )
    )
    leaves = _leaves(representatives, runs, branch, limit)
    candidates = stored(_candidates(leaves, representatives, threshold))
    wanted = candidates.select("rid").distinct().join(representatives, "rid").select("rid", *[F.col(f"first.{k}").alias(k) for k in KEY])
    found = stored(_verified(candidates, _sets(docs, wanted, shingle), representatives.select("rid", "copies"), threshold))
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    labels = stored(representatives.select("rid", "first", "least_id", "copies").join(components(found), "rid", "left").join(links, "rid", "left").withColumn("label", F.coalesce("label", "rid")))
    classes = labels.groupBy("label").agg(F.min("least_id").alias("class_id"), F.min("first").alias("class_first"))
    of = labels.join(classes, "label").select("rid", "class_id", "class_first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"))
    return signed.drop("signature").join(of, "rid", "left").select(
        "doc_id", *KEY, "rid", F.when(F.col("rid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"), (F.col("rid").isNull() | (order == F.col("class_first"))).alias("first"),
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, target: float = TARGET) -> DataFrame:
    """The rows of ``docs`` that are first in their class, one of repeated rows, with all their columns.

    Rows without words all stay.
    """
    classes = similar(docs, threshold, shingle, target)
    kept = classes.where("first").select(*KEY, F.col("rid").isNull().alias("blank")).distinct()
    names = {k: fresh(docs, k) for k in (*KEY, "blank")}
    keyed = docs.select("*", *[c.alias(names[k]) for k, c in zip(KEY, row_key(F.col("doc_id"), F.col("text")), strict=True)])
    joined = keyed.join(kept.select(*[F.col(k).alias(n) for k, n in names.items()]), [names[k] for k in KEY])
    worded = joined.where(~F.col(names["blank"])).dropDuplicates([names[k] for k in KEY])
    return worded.unionByName(joined.where(names["blank"])).select(*[F.col(f"`{c}`") for c in docs.columns])


ship(__name__)
