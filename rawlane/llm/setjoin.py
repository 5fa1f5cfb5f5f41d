"""Jaccard join of documents as sets of word shingles, by a token-group matrix.

Documents with equal sets are one node. Nodes are range-partitioned by a step of their size and then by their smallest
hashes under two permutations, so similar ones become neighbours, and every partition is cut into groups of bounded size
and one step of sizes: linked sets are at most one step apart. A group links its own nodes in one task. For links across
groups the matrix holds, per group, the union of its members' tokens; what a query shares with that union bounds what it
shares with any member. The bound is applied twice: on short prefixes of all sets in one common order, with one row per
token and group, which finds the groups worth opening; and inside an opened group on the whole union, before any member is
looked at.

Tokens that the same components hold are one weighted row of the matrix. A component has to share so much with a group that
its most widespread tokens, up to just below that much, are not needed to find the group. So a passage that a third of all documents hold brings nobody together.

The common order puts tokens last that are frequent inside some group, by a table of counts of fixed size (tokens that
share an entry share its count), so a passage that many documents hold rarely gets into their prefixes. Links are complete
under any order: the table only decides how many groups are opened in vain.

Within a group, prefixes follow the group's own token frequencies, rarest first, so passages that many documents share
bring up no candidates. Links are verified exactly on the sets. Two nodes already known to be in one component are not
compared again, so a group of copies costs one comparison per copy and no pairs are listed. Sets are compared as 64-bit
hashes of shingles, nodes told apart by a 128-bit hash of their set.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.llm.arrow_text import buffers, mix, runs, shingle_hashes
from rawlane.llm.components import connected_components
from rawlane.session import work_path

#: A group ends with whichever comes first; a document with more tokens than that is a group with few others.
GROUP_NODES, GROUP_TOKENS = 2048, 2_000_000
#: Bits of a node's number: step of sizes, partition, group in the partition, place in the group.
STEP_BITS, PARTITION_BITS, CHUNK_BITS, PLACE_BITS = 7, 24, 20, 12
#: Members of a group that hold a token before the group reports it as frequent, and entries of the table of counts.
FREQUENT_MEMBERS, COUNT_ENTRIES = 8, 1 << 20
#: Bytes of text that are unpacked at a time.
RUN_BYTES = 1 << 20
#: Queries of one group that a task answers before another task opens the group too.
QUERIES_PER_BLOCK = 4096


def least_shared(n: np.ndarray | int, percent: int):
    """Tokens that a set of ``n`` shares at least with any set it is linked to."""
    return -(-n * percent // 100)


def extra(n: np.ndarray | int):
    """By how much prefixes in the common order are longer than needed: so many more tokens have to agree.

    With as many again as are needed, a passage that makes up less than half of a document no longer sends it anywhere.
    """
    return n * 3 // 20


def size_step(n: int, percent: int) -> int:
    """Sizes in steps by which linked sets differ at most by one (the width is a little more than their largest ratio)."""
    return min(int(math.log(n) / (1.001 * math.log(100 / percent))), (1 << STEP_BITS) - 1) if percent < 100 else 0


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets (sorted arrays) have a Jaccard similarity of ``percent`` or more."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    shared = int((large[at] == small).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


class Group:
    """The members of a group, its token union, and postings of the members' rarest tokens."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.union, inverse, self.frequency = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        keep = self.sizes - least_shared(self.sizes, percent) + 1
        tokens, owners = [], []
        for i in range(len(sets)):
            own = inverse[bounds[i] : bounds[i + 1]]
            rare = own[np.argsort(self.frequency[own], kind="stable")[: keep[i]]]
            tokens.append(rare)
            owners.append(np.full(len(rare), i))
        tokens, owners = np.concatenate(tokens), np.concatenate(owners)
        order = np.argsort(tokens, kind="stable")
        self.owners = owners[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(tokens, minlength=len(self.union)))])

    def candidates(self, query: np.ndarray) -> np.ndarray:
        """Members that may be linked with the query; none if the group's union doesn't share enough with it."""
        n, least = len(query), least_shared(len(query), self.percent)
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        known = at[self.union[at] == query]
        take = len(known) - least + 1  # of a prefix, tokens that the union lacks come first
        if take <= 0:
            return np.zeros(0, np.int64)
        first = known[np.argsort(self.frequency[known], kind="stable")[:take]]
        seen = np.zeros(len(self.sets), bool)
        for token in first:
            seen[self.owners[self.starts[token] : self.starts[token + 1]]] = True
        out = np.flatnonzero(seen)
        return out[(self.sizes[out] >= least) & (least_shared(self.sizes[out], self.percent) <= n)]


def local_roots(group: Group) -> np.ndarray:
    """The smallest place reachable by links inside a group, for every place."""
    sets, percent, roots = group.sets, group.percent, np.arange(len(group.sets))

    def join(i: int, j: int) -> None:
        low, high = sorted((roots[i], roots[j]))
        roots[roots == high] = low

    for i in range(1, len(sets)):  # neighbours in the order of smallest hashes are often copies
        if linked(sets[i], sets[i - 1], percent) or linked(sets[i], sets[roots[i - 1]], percent):
            join(i, i - 1)
    for i in range(len(sets)):
        others = group.candidates(sets[i])
        others = others[(others > i) & (roots[others] != roots[i])]
        while len(others):
            j, others = int(others[0]), others[1:]
            if linked(sets[i], sets[j], percent):
                join(i, j)
                others = others[roots[others] != roots[i]]
    return roots


def _set_key(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


_SECOND = np.uint64(0xD6E8FEB86659FD93)


def _set_runs(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The sets of a batch of texts in runs of some ``RUN_BYTES``, each with the number of its first row. A batch has
    thousands of texts, whose hashes together take several times the memory of their bytes."""
    for begin, end in runs(buffers(texts)[1], RUN_BYTES):
        yield begin, shingle_hashes(texts.slice(begin, end - begin), width)


def _prepare(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per different set and task: step of its size, two smallest hashes, key, compressed text."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for begin, sets in _set_runs(batch.column(0), width):
                rows = []
                for i, tokens in enumerate(sets, begin):
                    if len(tokens) and (key := _set_key(tokens)) not in seen:
                        seen.add(key)
                        least, second = tokens[0], mix(tokens ^ _SECOND).min()
                        rows.append((size_step(len(tokens), percent), np.uint64(least).view(np.int64), second.view(np.int64), key, pack.compress(batch.column(0)[i].as_py().encode())))
                if rows:
                    columns = zip(zip(*rows, strict=True), (*[pa.int64()] * 3, pa.binary(), pa.binary()), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], ["step", "m1", "m2", "key", "packed"])

    return docs.select("text").mapInArrow(sets, "step long, m1 long, m2 long, key binary, packed binary")


def _tokens(packed: list[bytes], width: int) -> list[np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    return shingle_hashes(pa.array([unpack.decompress(x).decode() for x in packed], pa.large_string()), width)


def _token_runs(packed: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The sets of a batch in runs of some ``RUN_BYTES`` of text, each with the number of its first row."""
    texts = packed.to_pylist()
    sizes = np.array([zstandard.frame_content_size(x) for x in texts], np.int64)
    for begin, end in runs(np.append(0, np.cumsum(sizes)), RUN_BYTES):
        yield begin, _tokens(texts[begin:end], width)


def _group(prepared: DataFrame, groups: int, width: int, percent: int) -> DataFrame:
    """Nodes dealt into groups and linked inside them: ``node, key, root, n, packed``, and in a group's first row
    ``entries, members``: how many members hold each of its frequent tokens, by entry of the table of counts."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, last, step = TaskContext.get().partitionId(), 0, None, None
        held: list[tuple[bytes, bytes]] = []
        sets: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            base = ((step << PARTITION_BITS | part) << CHUNK_BITS | chunk) << PLACE_BITS
            group = Group(sets, percent)
            columns = [base + np.arange(len(sets)), pa.array([k for k, _ in held], pa.binary()), base + local_roots(group), group.sizes]
            often = group.frequency >= FREQUENT_MEMBERS
            counts = (_entries(group.union[often]).astype(np.int32), group.frequency[often].astype(np.int32))
            counts = [pa.array([c, *[None] * (len(sets) - 1)], pa.list_(pa.int32())) for c in counts]
            return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([p for _, p in held], pa.binary()), *counts], ["node", "key", "root", "n", "packed", "entries", "members"])

        for batch in batches:
            steps, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for begin, run in _token_runs(batch.column(2), width):
                packed, own = batch.column(2).slice(begin, len(run)).to_pylist(), slice(begin, begin + len(run))
                for its, key, text, tokens in zip(steps[own], keys[own], packed, run, strict=True):
                    if key == last:
                        continue
                    if held and (its != step or len(held) >= GROUP_NODES or size + len(tokens) > GROUP_TOKENS):
                        yield close()
                        chunk, held, sets, size = chunk + 1, [], [], 0
                    step = its
                    held.append((key, text))
                    sets.append(tokens)
                    size, last = size + len(tokens), key
        if held:
            yield close()

    order = ("step", "m1", "m2", "key")
    ordered = prepared.repartitionByRange(groups, *order).sortWithinPartitions(*order)
    return ordered.select("step", "key", "packed").mapInArrow(link, "node long, key binary, root long, n long, packed binary, entries array<int>, members array<int>")


def _entries(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(COUNT_ENTRIES - 1)).astype(np.int64)


def _rank_of_entries(nodes: DataFrame) -> np.ndarray:
    """Per entry of the table of counts the logarithm of how many members of reporting groups hold its tokens; zero for
    most. The table has ``COUNT_ENTRIES`` entries at most, one byte each, however many documents there are."""
    reported = nodes.where("entries IS NOT NULL").select(F.explode(F.arrays_zip("entries", "members")).alias("e")).select("e.*")
    summed = reported.groupBy("entries").agg(F.floor(F.log2(F.sum("members"))).cast("int").alias("rank")).toArrow()
    ranks = np.zeros(COUNT_ENTRIES, np.uint8)
    ranks[summed["entries"].to_numpy()] = summed["rank"].to_numpy()
    return ranks


def _group_of(node: str) -> Column:
    return F.shiftright(node, PLACE_BITS)


def _step_of(group: Column) -> Column:
    return F.shiftright(group, PARTITION_BITS + CHUNK_BITS)


def _matrix(nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """``token, root``: for every local component, the union of its members' prefixes in the common order."""
    ranks = _rank_of_entries(nodes)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, roots = [], []
            for begin, run in _token_runs(batch.column(1), width):
                for own, root in zip(run, batch.column(0).slice(begin, len(run)).to_pylist(), strict=True):
                    order = np.argsort(ranks[_entries(own)], kind="stable")  # tokens of equal rank stay in hash order
                    own = own[order[: len(own) - least_shared(len(own), percent) + 1 + extra(len(own))]]
                    tokens.append(own)
                    roots.append(np.full(len(own), root, np.int64))
            pairs = np.unique(np.stack([np.concatenate(roots), np.concatenate(tokens).view(np.int64)]), axis=1) if len(set(batch.column(0).to_pylist())) < batch.num_rows else np.stack([np.concatenate(roots), np.concatenate(tokens).view(np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(pairs[1]), pa.array(pairs[0])], ["token", "root"])

    return nodes.select("root", "packed").mapInArrow(prefixes, "token long, root long")


def _open(nodes: DataFrame, queries: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between queries and the members of the groups they are sent to, as ``a, b`` (local components).

    ``queries``: ``node, root, goal`` (a group). One link per query and local component of the group is enough. A group
    with many queries is opened by several tasks.
    """
    wanted = queries.groupBy("goal").agg(F.ceil(F.count("*") / QUERIES_PER_BLOCK).cast("int").alias("blocks"))
    asked = queries.select("node", "root", "goal").join(wanted, "goal")
    asked = asked.select("node", "root", "goal", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"))
    asked = asked.join(nodes.select("node", "packed"), "node").select("goal", "block", F.lit(1).alias("role"), "root", "packed")
    members = nodes.withColumn("goal", _group_of("node")).join(wanted, "goal")
    members = members.select("goal", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("role"), "root", "packed")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, members, roots, group = None, [], [], None
        for batch in batches:
            goal, block, role, root = (batch.column(i).to_pylist() for i in range(4))
            found: list[tuple[int, int]] = []
            for begin, run in _token_runs(batch.column(4), width):
                for i, own in enumerate(run, begin):
                    if (goal[i], block[i]) != here:
                        here, members, roots, group = (goal[i], block[i]), [], [], None
                    if role[i] == 0:
                        members.append(own)
                        roots.append(root[i])
                        continue
                    if group is None:
                        group, of = Group(members, percent), np.array(roots)
                    others = group.candidates(own)
                    while len(others):
                        if linked(own, members[others[0]], percent):
                            found.append((root[i], int(of[others[0]])))
                            others = others[of[others] != of[others[0]]]
                        else:
                            others = others[1:]
            if found:
                a, b = zip(*set(found), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    rows = members.unionByName(asked).repartition("goal", "block").sortWithinPartitions("goal", "block", "role")
    return rows.mapInArrow(answer, "a long, b long").distinct()


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def similar_sets(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, text_hash`` of every row of ``docs``.

    A document's set are its distinct ``width``-word shingles after folding A-Z, over the whole text. Documents are linked
    when 100 * intersection >= ``percent`` * union; a component's id is the smallest document id in it. Documents without
    words, NULL text included, are linked with nothing: each is its own component. Every row gives one row, repeated rows
    too; a row with a NULL id belongs to its component like any other, whose id is the smallest that is not NULL (NULL if
    there is none). Other columns are ignored. ``text_hash`` tells rows with equal ids apart.
    """
    spark, folder = docs.sparkSession, work_path(docs.sparkSession, "setjoin")
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    keyed = T.StructType.fromDDL("text_hash long, key binary, n_shingles long")
    keyed = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *keyed.fields])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, sizes = [], []
            for _, sets in _set_runs(batch.column(1), width):
                named += [_set_key(s) if len(s) else None for s in sets]
                sizes += map(len, sets)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(named, pa.binary()), pa.array(sizes, pa.int64())], keyed.names)

    rows = _written(docs.select("doc_id", "text", "text_hash").mapInArrow(keys, keyed), f"{folder}/rows")
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    groups = max(1, -(-classes.count() // (GROUP_NODES * 3 // 4)))
    nodes = _written(_group(_prepare(docs, width, percent), groups, width, percent), f"{folder}/nodes")
    components = _across(spark, nodes, folder, width, percent)

    of_key = nodes.select("key", "root").join(components.withColumnRenamed("node", "root"), "root", "left")
    of_key = of_key.select("key", F.coalesce("component", "root").alias("component"))
    of_key = classes.join(of_key, "key")
    least = of_key.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of_key.join(least, "component").select("key", "component_id", "component")
    out = rows.join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), "text_hash", F.col("key").isNull().alias("without_words"), "component")


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one document of each component does.

    It is the one with the smallest id (NULL counts as larger than any), of several texts with that id the one with the
    smallest hash, of repeated rows any one. Documents without words are linked with nothing and all stay.
    """
    found = similar_sets(docs, width, percent, doc_id, text)
    apart = F.when(F.col("without_words"), F.struct("doc_id", "text_hash"))
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    stay = found.groupBy("component", apart.alias("apart")).agg(F.min(rank).alias("stay"), F.first("without_words").alias("each"))
    stay = stay.select(F.col("stay.doc_id").alias("id"), F.col("stay.text_hash").alias("hash"), "each")
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("own_hash"), docs[doc_id].alias("own_id"))
    met = rows.join(stay, (F.col("own_hash") == F.col("hash")) & F.col("own_id").eqNullSafe(F.col("id")))
    once = met.where("NOT each").dropDuplicates(["own_hash", "own_id"])
    kept = once.unionByName(met.where("each"))
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def _weighted(shared: DataFrame) -> DataFrame:
    """``token, root, weight, spread``: of the tokens that exactly the same roots hold one is left, with their number as its
    weight; ``spread`` is how many roots hold it. Lists of roots are told apart by their length and two 64-bit sums."""
    lists = shared.groupBy("token").agg(F.count("*").alias("spread"), F.bit_xor(F.xxhash64("root")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "root")).alias("y"))
    alike = lists.groupBy("spread", "x", "y").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    return shared.join(alike.select("token", "weight", "spread"), "token")


def _across(spark: SparkSession, nodes: DataFrame, folder: str, width: int, percent: int) -> DataFrame:
    """Components of local components, by links across groups: ``node, component`` for those that have any."""
    by_token = Window.partitionBy("token")
    group = _group_of("root")
    spread = _matrix(nodes, width, percent).withColumns({"lo": F.min(group).over(by_token), "hi": F.max(group).over(by_token)})
    shared = _written(spread.where("lo < hi").select("token", "root").distinct(), f"{folder}/matrix")
    # what a component's members have to share at least, on their prefixes, with any member of another group
    sizes = F.ceil(F.col("n") * percent / F.lit(100))
    least = nodes.groupBy("root").agg(F.min(1 + F.floor(sizes * 3 / 20)).alias("need"), F.count("*").alias("members"))

    # a component that shares too little with all other groups together shares too little with each
    rich = shared.groupBy("root").agg(F.count("*").alias("shared")).join(least, "root").where("shared >= need")
    shared = _written(_weighted(shared.join(rich.select("root"), "root", "left_semi")), f"{folder}/rich")
    unions = shared.select("token", group.alias("goal")).distinct()
    apart = (group < F.col("goal")) & (_step_of(F.col("goal")) - _step_of(group) <= 1)

    # whatever shares ``need`` tokens with a component shares one beyond its most widespread ones of a weight below that
    widest = Window.partitionBy("root").orderBy(F.desc("spread"), "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    telling = shared.join(least, "root").withColumn("passed", F.sum("weight").over(widest)).where("passed >= need").select("token", "root")
    # so few of these pairs share less than ``need`` in all that counting would cost more than asking
    met = telling.join(unions, "token").where(apart).select("root", "goal").distinct()
    worth = _written(met.join(least.select("root", "members"), "root"), f"{folder}/worth")

    # first every component asks with one node; for most this is all they have
    first = _written(_open(nodes, worth.select(F.col("root").alias("node"), "root", "goal"), width, percent), f"{folder}/links")
    components = connected_components(first)

    # then components of several nodes ask with all of them, where a component that shares tokens is not yet joined. One row
    # per token and group says so: of the components that hold the token there, the least and the greatest
    label = components.select(F.col("node").alias("root"), "component")
    labelled = shared.join(label, "root", "left").withColumn("component", F.coalesce("component", "root"))
    theirs = labelled.groupBy("token", group.alias("goal")).agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    several = worth.where("members > 1").select("root", "goal")
    asking = telling.join(several.select("root").distinct(), "root", "left_semi").join(label, "root", "left")
    asking = asking.withColumn("mine", F.coalesce("component", "root")).join(theirs, "token").where(apart & ((F.col("lo") != F.col("mine")) | (F.col("hi") != F.col("mine"))))
    # counting what each pair shares in all would leave out next to none of these, and has a row per pair and token
    rest = _written(asking.select("root", "goal").distinct().join(several, ["root", "goal"], "left_semi"), f"{folder}/rest")
    if rest.limit(1).count() == 0:
        return components
    members = nodes.select("node", "root").join(rest, "root").select("node", "root", "goal")
    second = _written(_open(nodes, members, width, percent), f"{folder}/more-links")
    return connected_components(first.union(second))
