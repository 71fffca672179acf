"""Near duplicates: MinHash with tensored banding, verified on whole shingle sets.

A text is the set of its distinct shingles of some words (three, unless told otherwise); texts
whose sets overlap by at least a given part of their union (85 %) are linked, and each component
of linked texts keeps one.

Plain banding with keys of four hashes in 66 tables needs 264 minhashes. Tensored banding
makes 12 small collections of two minhashes each and forms the table keys from all 66 pairs
of collections: 24 minhashes. Texts of similarity s meet in a table unless fewer than two
collections agree; with s = 0.85 that has a probability of 7 in a million. At other similarities
there are as many collections as keep it under 10 in a million (15 at 0.80). A text is dropped
from the tables early if fewer than two of its collections agree with any other text.

Equal sets are one class from the start, so that copies cost one row each. Classes that meet
in a table are candidates; instead of emitting their pairs, each is joined to the smallest of
its table, and the components of these edges are the clusters in which links can lie. In
a cluster, the members are compared on their whole sets: a member is compared with all others
at once by counting, over an index of the cluster's shingles. Pairs within a component that
is already linked need no comparison, so that most members of a group of copies are never
taken up; all other pairs are compared. Clusters with many shingles are cut into blocks. Each
block is linked by itself, then the central members of the blocks among themselves, which
makes one component of a large group of copies in work linear in its size. What remains of such
a cluster are the members outside its largest component. Many texts can meet there that only share a
passage, so they are not compared with all of the cluster: of two sets that overlap enough, one has to
hold one of the first shingles of the other, whatever the order of shingles, if so many come first that the
rest is too few. In an order that begins with shingles that are rare in the cluster, those first ones
tell texts with a common passage apart. Members that share a first shingle with one that remains
make smaller clusters, and in these the remaining meet all, block by block. No pair is capped or sampled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tonearm.llm.blocks import mapped, runs, written
from tonearm.llm.components import connected_components
from tonearm.llm.texts import LOWER, NOT_SPACE, ODD, U64, Spans, batch, grams, mix, text_slices, whole_grams, words

SHINGLE = 3
COLLECTIONS, HASHES = 12, 2
PERCENT = 85
#: Pairs of exactly the given similarity that may be missed by the tables.
MISSED = 1e-5
BLOCK_SHINGLES = 200_000
#: Tasks of cluster members that may be broadcast to the texts: about 150 bytes each, 30 MB. More are joined by a shuffle.
BROADCAST_ROWS = 200_000


def collections_for(percent: int) -> int:
    """The least number of collections of which fewer than two agree for at most `MISSED` of the pairs at that similarity."""
    agree, n = (percent / 100) ** HASHES, 2
    while (1 - agree) ** n + n * agree * (1 - agree) ** (n - 1) > MISSED:
        n += 1
    return n


def shingles(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, and the bounds of each text's; a text of fewer words than a shingle is one shingle."""
    low = LOWER[data]
    start, stop, first = words(low, offsets, NOT_SPACE)
    h = Spans(low).hash(start, stop)
    n = np.diff(first)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(bounds[-1], U64)
    short = np.zeros(bounds[-1], bool)
    for k in range(1, shingle):
        texts = np.flatnonzero(n == k)
        out[bounds[texts]] = grams(h, k)[first[texts]]
        short[bounds[texts]] = True
    out[~short] = grams(h, shingle)[whole_grams(first, shingle)]
    return out, bounds


def minhashes(values: np.ndarray, bounds: np.ndarray, collections: int = COLLECTIONS) -> np.ndarray:
    """One row per text with shingles: a hash for each collection, made of its minhashes."""
    begin = bounds[:-1][np.diff(bounds) > 0]
    out = np.zeros((len(begin), collections), U64)
    seeds = mix(np.arange(1, 2 * collections * HASHES + 1, dtype=U64) * ODD)
    flip, scale = seeds[: collections * HASHES], seeds[collections * HASHES :] | U64(1)
    if len(begin):
        for k in range(collections * HASHES):
            least = np.minimum.reduceat((values ^ flip[k]) * scale[k], begin)
            out[:, k // HASHES] = mix(out[:, k // HASHES] * ODD + least)
    return out


def set_name(members: np.ndarray) -> bytes:
    """128-bit name of a set of shingles, given in order."""
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _sign(shingle: int, collections: int):
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first, last, data, offsets in text_slices(rows.column("text")):
                values, bounds = shingles(data, offsets, shingle)
                counts, names = [], []
                for i in range(last - first):
                    members = np.unique(values[bounds[i] : bounds[i + 1]])
                    counts.append(len(members))
                    names.append(set_name(members) if len(members) else None)
                table = minhashes(values, bounds, collections).view(np.int64)
                sizes = np.where(np.diff(bounds) > 0, collections, 0)
                parts = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(table.ravel(), pa.int64())
                )
                own = rows.slice(first, last - first)
                yield batch(
                    doc_id=own.column("doc_id"), text_hash=own.column("text_hash"), n_shingles=(counts, pa.int64()),
                    node=(names, pa.binary()), parts=parts,
                )

    return sign


def candidate_edges(classes: DataFrame) -> DataFrame:
    """Edges from each class to the smallest one it meets in a table."""
    each = classes.select("node", F.posexplode("parts").alias("i", "part"))
    agreed = each.groupBy("i", "part").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    lists = each.join(agreed, ["i", "part"]).groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("i", "part"))).alias("a")
    )
    keys = F.expr(
        "flatten(transform(a, (x, k) -> transform(slice(a, k + 2, size(a)), y -> xxhash64(x.i, x.part, y.i, y.part))))"
    )
    keyed = lists.where("size(a) > 1").select("node", F.explode(keys).alias("key"))
    leads = keyed.groupBy("key").agg(F.min("node").alias("lead"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(leads, "key").where("node <> lead").select(F.col("node").alias("u"), F.col("lead").alias("v"))


def linked(
    names: list[bytes], sets: list[np.ndarray], labels: list[bytes] | None = None, percent: int = PERCENT
) -> tuple[list[tuple[bytes, bytes]], bytes]:
    """Links that connect what is similar: a spanning forest of the similarity graph of these sets, of
    which those with equal labels are connected already. Also gives the most central one."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    code, distinct = pd.factorize(np.concatenate(sets))
    by_code = np.argsort(code, kind="stable")
    postings = owner[by_code]
    edges = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(distinct)))])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    common = np.diff(edges)
    central = np.add.reduceat(common[code].astype(np.float64), bounds[:-1]) / sizes
    label, taken, links = np.arange(n), np.zeros(n, bool), []
    if labels is not None:
        label = pd.factorize(np.array(labels, dtype=object))[0].astype(np.int64)
    fresh = bool((np.bincount(label) == 1).all())
    while True:
        left = np.flatnonzero(~taken)
        if not len(left):
            break
        of = label[left]
        main = np.bincount(of).argmax()
        if (of == main).all():
            break
        # The most central one first, where none are connected yet; then those outside the largest
        # component, until it holds all that are left.
        choice = left if fresh and not taken.any() else left[of != main]
        one = choice[central[choice].argmax()]
        taken[one] = True
        own = code[bounds[one] : bounds[one + 1]]
        begin, size = edges[own], common[own]
        at = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        shared = np.bincount(postings[at], minlength=n)
        near = np.flatnonzero(100 * shared >= percent * (sizes + sizes[one] - shared))
        for other in near[label[near] != label[one]].tolist():
            if label[other] != label[one]:
                links.append((names[one], names[other]))
                label[label == label[other]] = label[one]
    return links, names[int(central.argmax())]


def _sets_of(shingle: int):
    """The shingle sets of cluster members; rows of other texts with the same id are left out."""

    def sets_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first, last, data, offsets in text_slices(rows.column("text")):
                values, bounds = shingles(data, offsets, shingle)
                kept, bodies = [], []
                for i in range(last - first):
                    members = np.unique(values[bounds[i] : bounds[i + 1]])
                    if set_name(members) == rows.column("node")[first + i].as_py():
                        kept.append(first + i)
                        bodies.append(members.tobytes())
                chosen = rows.take(pa.array(kept, pa.int64()))
                yield batch(
                    node=chosen.column("node"), label=chosen.column("label"), tasks=chosen.column("tasks"),
                    body=(bodies, pa.binary()),
                )

    return sets_of


def _compare(percent: int):
    """Links between the members of each task, and its most central member as a link to itself."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for _, members in runs(batches, "task"):
            own = {row["node"].to_pybytes(): row for row in members}
            sets = [np.frombuffer(row["body"].to_pybytes(), U64) for row in own.values()]
            links, centre = linked(list(own), sets, [row["label"].to_pybytes() for row in own.values()], percent)
            found += [*links, (centre, centre)]
            if len(found) > 10_000:
                yield batch(u=([a for a, _ in found], pa.binary()), v=([b for _, b in found], pa.binary()))
                found = []
        if found:
            yield batch(u=([a for a, _ in found], pa.binary()), v=([b for _, b in found], pa.binary()))

    return compare


def _dealt(texts: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """The shingle sets of members, once for each of their tasks: (task, node, label, body)."""
    members = written(members.select("member_id", "node", "label", "tasks"), "near-tasks")
    side = F.broadcast(members) if members.agg(F.coalesce(F.sum(F.size("tasks")), F.lit(0))).first()[0] <= BROADCAST_ROWS else members
    with_text = texts.join(side, texts.doc_id.eqNullSafe(side.member_id)).select("text", "node", "label", "tasks")
    sets = with_text.transform(mapped, _sets_of(shingle), "node binary, label binary, tasks array<string>, body binary")
    return sets.select(F.explode("tasks").alias("task"), "node", "label", "body")


def _compared(texts: DataFrame, members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links found in tasks; `members` has member_id, node, the label of what is connected already, and tasks."""
    dealt = _dealt(texts, members, shingle).repartition("task").sortWithinPartitions("task")
    return written(dealt.transform(mapped, _compare(percent), "u binary, v binary"), "near-links")


def _common(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles that more than one member of a task holds, of each task."""
    for task, members in runs(batches, "task"):
        own = {row["node"].to_pybytes(): row["body"].to_pybytes() for row in members}
        values, counts = np.unique(np.concatenate([np.frombuffer(b, U64) for b in own.values()]), return_counts=True)
        yield batch(task=([task], pa.string()), common=([values[counts > 1].tobytes()], pa.binary()))


def first_shingles(members: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, in an order in which the common ones come last.

    Sets that overlap by at least `percent` share that part of each of them, so that they share one of these.
    """
    n = len(members)
    late = np.isin(members, common, assume_unique=True)
    return members[np.argsort(late, kind="stable")][: n - (percent * n + 99) // 100 + 1]


def _first(percent: int):
    """The first shingles of the members of each task; the first row of a task has the common ones of its cluster."""

    def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def closed() -> pa.RecordBatch:
            size = np.array([len(own) for _, _, _, own in held])
            tasks, nodes, rest = (pa.array(column) for column in list(zip(*held))[:3])
            at = pa.array(np.repeat(np.arange(len(held)), size))
            return batch(
                task=tasks.take(at), shingle=(np.concatenate([own for *_, own in held]), pa.int64()), node=nodes.take(at), rest=rest.take(at)
            )

        for task, members in runs(batches, "task"):
            common = np.zeros(0, U64)
            for row in members:
                body = np.frombuffer(row["body"].to_pybytes(), U64)
                if row["node"] is None:
                    common = body
                    continue
                own = first_shingles(body, common, percent).view(np.int64)
                held.append((task, row["node"].to_pybytes(), row["label"].to_pybytes() == b"rest", own))
                if len(held) == 1000:
                    yield closed()
                    held.clear()
        if held:
            yield closed()

    return first


def _in_blocks(members: DataFrame) -> DataFrame:
    """Adds into how many blocks the cluster (`root`) of a member is cut."""
    blocks = members.groupBy("root").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    return members.join(blocks, "root")


def _block_of(blocks: str) -> Column:
    return F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")


def _placed(members: DataFrame) -> DataFrame:
    """Adds the label of the largest component (`main`) of the cluster, and drops clusters that are one component."""
    sizes = members.groupBy("root", "label").agg(F.sum("n_shingles").alias("size"))
    largest = sizes.groupBy("root").agg(
        F.max(F.struct("size", "label")).alias("main"), F.sum("size").alias("all"), F.count("*").alias("n")
    )
    cut = largest.where("n > 1").select(
        "root", F.col("main.label").alias("main"),
        F.ceil(F.col("main.size") / BLOCK_SHINGLES).cast("int").alias("main_blocks"),
        F.ceil((F.col("all") - F.col("main.size")) / BLOCK_SHINGLES).cast("int").alias("rest_blocks"),
    )
    return members.join(cut, "root")


def _by_first_shingles(texts: DataFrame, members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Members with a new, smaller cluster as their `root`: what shares first shingles with a member outside
    the largest component of its cluster. All others have no link that isn't found yet.

    The order of shingles has to be one for a whole cluster, but may be any: common ones are told by one block.
    """
    name, block = F.hex("root"), _block_of("blocks")
    placed = _placed(members).withColumn("label", F.when(F.col("label") == F.col("main"), F.lit(b"main")).otherwise(F.lit(b"rest")))
    sets = written(
        _dealt(texts, placed.withColumn("tasks", F.array(F.concat_ws("/", name, block))), shingle), "near-sets"
    )
    one = sets.where("task LIKE '%/0'").repartition("task").sortWithinPartitions("task")
    common = one.transform(mapped, _common, "task string, common binary")
    blocks = placed.select(F.concat_ws("/", name, F.lit("0")).alias("task"), "root", "blocks").distinct()
    sent = common.join(blocks, "task").select(
        F.explode(F.expr("sequence(0, blocks - 1)")).alias("b"), "root", F.col("common").alias("body")
    ).select(F.concat_ws("/", name, "b").alias("task"), F.lit(None).cast("binary").alias("node"), F.lit(None).cast("binary").alias("label"), "body")
    dealt = sets.unionByName(sent).repartition("task").sortWithinPartitions("task", F.asc_nulls_first("node"))
    firsts = dealt.transform(mapped, _first(percent), "task string, shingle long, node binary, rest boolean")
    firsts = written(firsts.withColumn("cluster", F.substring_index("task", "/", 1)).drop("task"), "near-first")
    leads = firsts.groupBy("cluster", "shingle").agg(
        F.min("node").alias("lead"), F.count("*").alias("n"), F.max("rest").alias("rest")
    ).where("n > 1 AND rest")
    edges = firsts.join(leads.select("cluster", "shingle", "lead"), ["cluster", "shingle"]).where("node <> lead")
    smaller = connected_components(edges.select(F.col("node").alias("u"), F.col("lead").alias("v")), "near-smaller")
    return members.drop("root", "blocks").join(smaller, "node")


def _rest_and_all(members: DataFrame) -> DataFrame:
    """Tasks in which the members outside the largest component of a cluster meet all of its members."""
    placed = _placed(members).withColumn("name", F.hex("root"))
    main = placed.where("label = main").withColumn("b", _block_of("main_blocks")).withColumn(
        "tasks", F.expr("transform(sequence(0, rest_blocks - 1), i -> concat_ws('/', name, i, 'main', b))")
    )
    rest = placed.where("label <> main").withColumn("b", _block_of("rest_blocks")).withColumn(
        "tasks",
        F.expr(
            "concat(transform(sequence(0, main_blocks - 1), i -> concat_ws('/', name, b, 'main', i)), "
            "transform(sequence(0, rest_blocks - 1), i -> concat_ws('/', name, least(b, i), 'rest', greatest(b, i))))"
        ),
    )
    return main.unionByName(rest)


def links_within(texts: DataFrame, classes: DataFrame, clusters: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Verified links (u, v) between classes of the same cluster, or links that join up the same components."""
    members = classes.join(clusters, "node").select(F.col("doc_id").alias("member_id"), "node", "root", "n_shingles")
    members = written(_in_blocks(members), "near-members")
    split = members.where("blocks > 1")
    task = F.concat_ws("/", F.hex("root"), _block_of("blocks"))
    level, links, before = members, None, None
    while True:
        dealt = level.select("*", F.col("node").alias("label"), F.array(task).alias("tasks"))
        found = _compared(texts, dealt, shingle, percent)
        links = found if links is None else links.unionByName(found)
        cut = level.where("blocks > 1")
        left = cut.count()
        # Centres of blocks are few; blocks of one long text each don't get fewer and are left to the last step.
        if not left or (before is not None and 2 * left > before):
            break
        before = left
        centres = found.where("u = v").select(F.col("u").alias("node"))
        level = written(_in_blocks(cut.drop("blocks").join(centres, "node", "left_semi")), "near-centres")
    links = links.where("u <> v")
    if before is not None:
        roots = connected_components(links, "near-blocks").withColumnRenamed("root", "connected")
        labelled = written(split.join(roots, "node", "left").withColumn("label", F.coalesce("connected", "node")), "near-labelled")
        smaller = written(_by_first_shingles(texts, labelled, shingle, percent), "near-again")
        links = roots.select(F.col("node").alias("u"), F.col("connected").alias("v")).where("u <> v")
        links = links.unionByName(_compared(texts, _rest_and_all(smaller), shingle, percent).where("u <> v"))
    return links


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", with_hash: bool = False, shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id and kept; `with_hash` adds xxhash64 of the text.

    Texts are linked if their sets of shingles of `shingle` words overlap by at least `percent` of their union.
    component_id is the smallest id of the component; kept is true for the rows with that id. A
    null or empty text, or one without words, has no shingles and stays alone. Repeated rows
    belong to one component, and all rows with its smallest id are kept. A row without id takes
    the component's id; if no row of the component has an id, that is null and the rows are kept.
    An empty table gives no rows.
    """
    texts = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    hashed = texts.withColumn("text_hash", F.xxhash64("text"))
    schema = "doc_id long, text_hash long, n_shingles long, node binary, parts array<bigint>"
    signed = written(hashed.transform(mapped, _sign(shingle, collections_for(percent)), schema), "near-signed")
    classes = signed.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("parts").alias("parts")
    )
    classes = written(classes, "near-classes")
    clusters = connected_components(candidate_edges(classes), "near-clusters")
    components = connected_components(links_within(texts, classes, clusters, shingle, percent), "near-components")
    named = classes.select("node", "doc_id").join(components, "node", "left")
    named = named.select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_node = named.select("node", "root").join(least, "root").select("node", "component_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    rows = signed.select("doc_id", "text_hash", "n_shingles", "node").join(of_node, "node", "left")
    return rows.select(
        "doc_id", *(["text_hash"] if with_hash else []), "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
