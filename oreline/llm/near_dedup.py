"""Near-duplicate documents by a chosen-path set similarity join.

Documents with equal shingle sets are one class. Each class chooses minwise shingles at the roots of independent trees and
stands in a node for each. A node that is small is compared exhaustively: first a few partners of each member are confirmed, then,
where a member has more, those that this left in other components. In a large node all are compared with one
pivot, and what is still apart branches again by shingles chosen under the path. Comparisons in nodes use sketches that
carry a margin of six standard errors; every pair they let through is confirmed on the full sets.
Only pairs that are not connected yet are compared, so a group of copies ends its nodes as soon as it is
connected; no group is ever paired with itself.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from oreline.llm import exchange as X
from oreline.llm import textops as T
from oreline.llm.shared import ship, store

U = np.uint64
#: Bins of a sketch: the least shingle of each bin, one byte of its hash; 0 is an empty bin.
BINS = 512
#: Partners that a member of a node is first compared with on full sets.
_FEW = 8
#: Sets of at most so many shingles are also kept whole, as 32-bit hashes.
_WHOLE = 1024
_DOCS = 256
#: Children of each member of a large node. A pair at 0.75 that is in a large node loses it with 0.25 ** 4 at the first level and 0.0041 over all.
_WAYS = 4


def shingle_sets(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, ascending within each text, and the edges of the texts.

    Words are runs without the six ASCII blanks, A-Z lower-cased; a text of fewer than ``size`` words is one shingle.
    """
    data, offsets = T.flat(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
    data = T.LOWER[data]
    starts, ends, doc = T.words(data, offsets)
    h = T.span_hashes(data, starts, ends)
    n = len(offsets) - 1
    counts = np.bincount(doc, minlength=n)
    first = np.cumsum(counts) - counts
    rolled = T.windows(h, size, 4)
    at = np.flatnonzero(doc[: len(rolled)] == doc[size - 1 :][: len(rolled)])
    out, of = [rolled[at]], [doc[at]]
    for k in np.flatnonzero((counts > 0) & (counts < size)):
        out.append(T.windows(h[first[k] : first[k] + counts[k]], int(counts[k]), 100 + int(counts[k])))
        of.append([k])
    hashes, of = np.concatenate(out), np.concatenate(of).astype(np.int64)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[new], of[new]
    return hashes, np.searchsorted(of, np.arange(n + 1))


def _minwise(hashes: np.ndarray, starts: np.ndarray, salt) -> np.ndarray:
    """The least salted hash of each set; sets are not empty."""
    return np.minimum.reduceat(T.mix(hashes ^ salt), starts)


def _sketches(hashes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = np.zeros((len(edges) - 1, BINS), dtype=np.uint8)
    of = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    salted = T.mix(hashes ^ U(0x5BF03635))
    order = np.lexsort((salted, of))
    salted, bins = salted[order], (salted[order] >> U(55)).astype(np.int64)
    place = of * BINS + bins
    first = np.ones(len(place), dtype=bool)
    first[1:] = place[1:] != place[:-1]
    out.ravel()[place[first]] = 1 + (salted[first] >> U(20)) % U(255)
    return out


def _alike(one: np.ndarray, many: np.ndarray, n_one, n_many, threshold: float) -> np.ndarray:
    """Whether pairs of sketches may belong to sets that are alike, by sizes and by estimate."""
    filled = (one | many) != 0
    used = np.maximum(np.count_nonzero(filled, axis=-1), 1)
    equal = np.count_nonzero((one == many) & filled, axis=-1)
    # The bins sample the union of two alike sets without putting back, so the error falls as they cover it.
    union = np.maximum((n_one + n_many) / (1 + threshold), used)
    margin = 6 * np.sqrt(threshold * (1 - threshold) / used * np.maximum(1 - used / union, 0.01)) + 2 / used
    fits = np.minimum(n_one, n_many) >= threshold * np.maximum(n_one, n_many) - 1e-9
    return fits & (equal / used >= threshold - margin)


def _sign(docs: DataFrame, size: int, roots: int) -> DataFrame:
    """doc_id, n, sid and check (two hashes of the set), sketch and the nodes at the roots; empty sets have none."""

    def sign(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, _DOCS):
                part = batch.slice(low, _DOCS)
                hashes, edges = shingle_sets(part.column("text"), size)
                n = np.diff(edges)
                has = np.flatnonzero(n > 0)
                starts = edges[has]
                sid, check = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
                nodes = np.zeros((len(n), roots), dtype=np.int64)
                if len(has):
                    sid[has] = np.add.reduceat(T.mix(hashes ^ U(77)), starts).view(np.int64)
                    check[has] = np.add.reduceat(T.mix(hashes ^ U(78)), starts).view(np.int64)
                    for k in range(roots):
                        nodes[has, k] = T.mix(_minwise(hashes, starts, U(1000 + k)) + U(k)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(sid), pa.array(check),
                     pa.array([x.tobytes() for x in _sketches(hashes, edges)], pa.binary()),
                     pa.array([x if m else [] for x, m in zip(nodes, n)], pa.list_(pa.int64()))],
                    names=["doc_id", "n", "sid", "check", "sketch", "nodes"],
                )

    return docs.mapInArrow(sign, "doc_id long, n long, sid long, check long, sketch binary, nodes array<long>")


_PAIR = "a long, b long"
_FOUND = "a long, b long, cut boolean"


def _found(pairs: list, node: int = 0, cut: list | None = None) -> pa.Table:
    """Pairs of ids, and for members whose list was cut a row of the node and the id."""
    a, b = (np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 2, *pairs))
    more = np.array(cut or [], dtype=np.int64)
    return pa.table({
        "a": np.concatenate([a, np.full(len(more), node)]), "b": np.concatenate([b, more]),
        "cut": np.concatenate([np.zeros(len(a), bool), np.ones(len(more), bool)]),
    })


def _within(threshold: float, most: int | None):
    """Pairs of a node's members with those before them, in the order of ids, that are in another component and may be alike.

    Of a member with more than ``most`` such partners the first ones are told and the member is named as cut. Only members
    marked as ``look`` are compared with those before them. Where ``whole`` sets are given, they decide instead of the sketches, with room
    for two shingles that share a hash.
    """

    def compare(got: pa.Table) -> pa.Table:
        order = np.argsort(got.column("id").to_numpy(), kind="stable")
        ids, n, comp, look = (got.column(c).to_numpy()[order] for c in ("id", "n", "comp", "look"))
        sketch = np.frombuffer(b"".join(got.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)[order]
        whole = [None] * len(ids)
        if "whole" in got.column_names:
            whole = [x and np.frombuffer(x, np.uint32) for x in got.column("whole").take(pa.array(order)).to_pylist()]
        found, cut = [], []
        for k in np.flatnonzero(look):
            fits = (comp[:k] != comp[k]) & (n[:k] >= threshold * n[k] - 1e-9) & (n[k] >= threshold * n[:k] - 1e-9)
            prior = np.flatnonzero(fits)
            prior = prior[_alike(sketch[k], sketch[prior], n[k], n[prior], threshold)]
            if whole[k] is not None:
                same = np.array([n[j] if whole[j] is None else len(np.intersect1d(whole[k], whole[j], True)) + 2 for j in prior], int)
                prior = prior[same >= threshold * (n[k] + n[prior] - same) - 1e-9]
            if most is not None and len(prior) > most:
                cut.append(ids[k])
                prior = prior[:most]
            if len(prior):
                found.append((np.full(len(prior), ids[k]), ids[prior]))
        return _found(found, got.column("node")[0].as_py(), cut)

    return compare


def _to_pivot(threshold: float):
    def compare(batches):
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("pivot_sketch", "sketch")
            )
            pivot, n = batch.column("pivot_n").to_numpy(), batch.column("n").to_numpy()
            ok = _alike(one, two, pivot, n, threshold) & (batch.column("pivot_comp").to_numpy() != batch.column("comp").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(batch.column(c).to_numpy()[ok], pa.int64()) for c in ("pivot", "id")), pa.array(np.zeros(ok.sum(), bool))],
                names=["a", "b", "cut"],
            )

    return compare


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union on the full sets."""

    def confirm(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, dtype=bool)
            for low in range(0, batch.num_rows, _DOCS):
                part = batch.slice(low, _DOCS)
                _, first, at = np.unique(np.concatenate([part.column(c).to_numpy() for c in ("a", "b")]), return_index=True, return_inverse=True)
                both = pa.concat_arrays([part.column("text_a"), part.column("text_b")])
                hashes, edges = shingle_sets(both.take(pa.array(first)), size)
                for k in range(part.num_rows):
                    one, two = (hashes[edges[i] : edges[i + 1]] for i in (at[k], at[part.num_rows + k]))
                    same = len(np.intersect1d(one, two, assume_unique=True))
                    ok[low + k] = 100 * same >= percent * (len(one) + len(two) - same)
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(c).to_numpy()[ok]) for c in ("a", "b")], names=["a", "b"])

    one = texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(confirm, _PAIR)


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """labels (id, comp) after the links (a, b) are drawn; a component's label is its least id.

    Links are first moved to the components of their ends, so earlier ones need not be seen again, and only components
    that a link moves take part. Each takes the least of its neighbours' labels, and then the label of its label, until nothing
    changes. Everything is kept in tables; one count reaches the driver per turn.
    """
    ends = links
    for side in ("a", "b"):
        to = labels.select(F.col("id").alias(side), F.col("comp").alias("to"))
        ends = ends.join(to, side).drop(side).withColumnRenamed("to", side)
    edges, moved = _counted(ends.union(ends.select("b", "a")).where("a <> b").distinct(), "edges", F.lit(True))
    if not moved:
        return labels
    after = store(
        edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("comp")), "turn"
    )
    while moved:
        of = after.select(F.col("id").alias("a"), F.col("comp").alias("theirs"))
        least = edges.join(of, "a").groupBy("b").agg(F.min("theirs").alias("least")).withColumnRenamed("b", "id")
        near = after.join(least, "id").select("id", F.col("comp").alias("was"), F.least("comp", "least").alias("comp"))
        jump = near.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
        turn = near.join(jump, "comp").select("id", F.least("comp", "next").alias("comp"), "was")
        after, moved = _counted(turn, "turn", F.col("comp") != F.col("was"))
        after = after.select("id", "comp")
    to = after.select(F.col("id").alias("comp"), F.col("comp").alias("to"))
    return store(labels.join(to, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), "labels")


def _counted(df: DataFrame, name: str, condition) -> tuple[DataFrame, int]:
    """The stored table, and for how many of its rows the condition holds, counted while it is written."""
    seen = Observation()
    table = store(df.observe(seen, F.count_if(condition).alias("n")), name)
    return table, seen.get["n"]


def near_duplicates(
    docs: DataFrame, percent: int = 75, size: int = 5, trees: int = 5, branches: int = 2, small: int = 8192, levels: int = 3,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Components of documents linked by 100 * intersection >= percent * union of their sets of ``size``-word shingles.

    A pair at 0.75 misses all ``trees * branches`` roots with 0.95e-6, and is missed with 1.1e-6 where all its nodes stay large on every
    level (by calculation, hashes taken as independent). Nodes of more than ``small`` members branch for ``levels`` levels (a branch shingles each text again, which costs about as much as so many comparisons of
    sketches); what is left then is compared in blocks, so no
    node is cut short. One row per input row: doc_id, n_shingles, component_id (smallest id reachable) and kept (the
    id is the component's). A null or wordless text has an empty set, is linked with nothing and kept. A null id comes after
    all others. Rows that share an id are documents of their own under one name. Other columns are not read. An empty
    table gives an empty result. Sets are told apart by 64 bits of hash.
    """
    ship(docs.sparkSession)
    threshold, roots = percent / 100, trees * branches
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = store(_sign(rows, size, roots), "signed")
    classes = store(
        signed.where("n > 0").groupBy("sid").agg(
            F.min(X.ranked("doc_id")).alias("rank"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"),
            F.any_value("nodes").alias("nodes"),
        ),
        "classes",
    )
    stands = classes.select("sid", F.explode("nodes").alias("node")).distinct()
    shared = stands.groupBy("node").count().where("count > 1").select("node")
    members = store(stands.join(shared, "node").select("node", F.col("sid").alias("id")), "members")
    active = members.select("id").distinct().withColumnRenamed("id", "sid")
    active = store(classes.drop("nodes").join(active, "sid"), "active")
    labels = store(active.select(F.col("sid").alias("id"), F.col("sid").alias("comp")), "labels")

    def own(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, _DOCS):
                part = batch.slice(low, _DOCS)
                hashes, edges = shingle_sets(part.column("text"), size)
                sums = np.concatenate([[U(0)], np.cumsum(T.mix(hashes ^ U(77)), dtype=U)])
                keep = (sums[edges[1:]] - sums[edges[:-1]]).view(np.int64) == part.column("sid").to_numpy()
                sets = [hashes[x:y] for x, y in zip(edges[:-1], edges[1:])]
                whole = [np.unique((x >> U(32)).astype(np.uint32)).tobytes() if len(x) <= _WHOLE else None for x in sets]
                yield part.select(["sid", "text"]).append_column("whole", pa.array(whole, pa.binary())).filter(pa.array(keep))

    # The text of each class: ids may repeat, so the set is looked at again.
    texts = rows.select(X.ranked("doc_id").alias("rank"), "text").join(active.select("rank", "sid"), "rank")
    texts = store(texts.select("sid", "text").mapInArrow(own, "sid long, text string, whole binary").dropDuplicates(["sid"]), "texts")

    def known(members: DataFrame) -> tuple[DataFrame, int]:
        """Members of nodes that hold several components, with size and pivot of their node; how many are in large nodes."""
        info = active.select(F.col("sid").alias("id"), "n", "sketch")
        full = members.join(labels, "id")
        apart = (
            full.groupBy("node")
            .agg(F.count("*").alias("size"), F.min("comp").alias("least"), F.max("comp").alias("last"), F.min("id").alias("pivot"))
            .where("least <> last").drop("least", "last")
        )
        return _counted(full.join(apart, "node").join(info, "id"), "known", F.col("size") > small)

    def confirmed(pairs: DataFrame) -> DataFrame:
        return store(_confirm(pairs.select("a", "b").distinct(), texts, size, percent), "links")

    waiting: list[DataFrame] = []
    for level in range(levels + 2):
        now, in_large = known(members.withColumn("look", F.lit(True)))
        # First a few partners of each member, or the pivot of a large node, so that groups of copies become connected.
        found = now.where(F.col("size") <= small).groupBy("node").applyInArrow(_within(threshold, _FEW), _FOUND)
        if in_large:
            pivots = now.where("id = pivot").select(
                "node", F.col("sketch").alias("pivot_sketch"), F.col("n").alias("pivot_n"), F.col("comp").alias("pivot_comp")
            )
            large = now.where((F.col("size") > small) & (F.col("id") != F.col("pivot")))
            found = found.union(large.join(pivots, "node").mapInArrow(_to_pivot(threshold), _FOUND))
        found, cut = _counted(found, "pairs", F.col("cut"))
        labels = components(confirmed(found.where(~F.col("cut"))), labels)
        # Then, for members with more partners, all that are still in another component. These nodes are done: their links can wait.
        if cut:
            again = found.where("cut").select(F.col("a").alias("node"), F.col("b").alias("id"), F.lit(True).alias("look"))
            mates = members.join(again.select("node").distinct(), "node", "left_semi").join(again, ["node", "id"], "left")
            mates, _ = known(mates.withColumn("look", F.coalesce("look", F.lit(False))))
            mates = mates.join(texts.select(F.col("sid").alias("id"), "whole"), "id")
            waiting.append(confirmed(mates.groupBy("node").applyInArrow(_within(threshold, None), _FOUND)))
        if not in_large:
            break
        rest, in_large = known(now.where(F.col("size") > small).select("node", "id"))
        if not in_large:
            members = rest.select("node", "id")
        elif level < levels:
            members = store(_branch(rest, texts, size), "members")
        else:
            members = _blocks(rest, small)
    if waiting:
        labels = components(reduce(DataFrame.union, waiting), labels)

    part = active.select("sid", F.col("rank")).join(labels.withColumnRenamed("id", "sid"), "sid")
    least = part.groupBy("comp").agg(F.min("rank").alias("component"))
    found = part.join(least, "comp").select("sid", "component")
    named = classes.select("sid", "rank").join(found, "sid", "left").select("sid", F.coalesce("component", "rank").alias("component"))
    out = signed.where("n > 0").select("doc_id", "n", "sid").join(named, "sid").select("doc_id", "n", "component").union(
        signed.where("n = 0").select("doc_id", "n", X.ranked("doc_id"))
    )
    component = F.when(F.col("component") != X.NO_ID, F.col("component"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (X.ranked("doc_id") == F.col("component")).alias("kept")
    )


def _branch(large: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The children of large nodes: _WAYS minwise shingles under the path, so that hardly a pair is lost on the way down."""

    def branch(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, _DOCS):
                part = batch.slice(low, _DOCS)
                hashes, edges = shingle_sets(part.column("text"), size)
                node, ids = part.column("node").to_numpy().view(U), part.column("id").to_numpy()
                of = np.repeat(np.arange(len(node)), np.diff(edges))
                for k in range(_WAYS):
                    path = T.mix(node + U(500 + k))
                    least = np.minimum.reduceat(T.mix(hashes ^ path[of]), edges[:-1])
                    child = T.mix(least ^ path).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(ids)], names=["node", "id"])

    told = large.select("node", "id").join(texts.select(F.col("sid").alias("id"), "text"), "id")
    children = told.select("node", "id", "text").mapInArrow(branch, "node long, id long")
    return children.join(children.groupBy("node").count().where("count > 1").select("node"), "node")


def _blocks(large: DataFrame, small: int) -> DataFrame:
    """Nodes for what no branching made small: each two blocks of a node's members meet in one of their own."""
    count = F.ceil(F.col("size") / (small / 4)).cast("int")
    placed = large.withColumn("blocks", count).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("node"), "id")
