"""Near-duplicate documents by bottom-k sketches of one hash function.

1. Each text becomes its set of word shingles (64-bit hashes). Documents with equal sets form a class; one row with its smallest id goes on. The
   sketch is the ``K`` smallest hashes of the set.
2. Inverted lists of the sketch values. Two sets with a similarity of 0.8 share at least ``least_shared`` sketch values (the chance of less is below
   1e-6 a pair; sets up to ``K`` are held whole and follow exactly), so they share one of the rarest ``size - least_shared + 1`` values of
   either: only these are listed, which leaves out the values that many documents share. Lists with equal members are read once, lists longer
   than ``LIST_BLOCK`` in pairs of blocks.
3. Within a list the bottom-k sketch of each pair's union estimates its similarity. Pairs above the estimate's lower bound connect; a task hands on a
   spanning forest, never the pairs. Components of these edges are the clusters: linked documents are in one cluster.
4. Within a cluster (in pairs of blocks of bounded size) the full sets give exact intersections. Again the links leave the task as a forest.
5. Components of the links; of a cluster that is one block the task has them already.

So no step makes rows for all pairs of a group, and no group meets in one task. Texts are read twice; sets are made for members of clusters only.

Defined cases: a NULL text or one without words has an empty set and is linked with nothing; a NULL id is returned with NULL component and kept;
repeated rows have equal sets; different texts under one id are a document each, whose links all count; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costledger.llm.common import block_pairs, by_groups, in_batches, shingle_sets, stored, whole_groups
from costledger.llm.graph import Forest, components, contracted

K = 48
#: Of ``K`` sketch values, those that sets with a similarity of 0.8 share at least: 38.4 are expected, with a deviation of 2.8.
LEAST_SHARED = 23
LEAST_ESTIMATE = LEAST_SHARED / K
LIST_BLOCK = 2048
#: Shingles and documents in a block of a cluster.
CLUSTER_BLOCK = 1_000_000
CLUSTER_DOCUMENTS = 2048
#: Shared shingles that are compared at once.
COLUMNS = 8192
#: Links have a similarity of at least ``PART`` / ``WHOLE``.
PART, WHOLE = 80, 100
PAD = np.iinfo(np.int64).max
#: Name of an added column, which documents do not have: tells apart the texts of one id.
MARK = "near__mark"


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id``, ``mark`` (of the text), ``n`` (set size), ``digest`` (of the set, NULL if empty), ``sketch``."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for found in shingle_sets(batch.column(1), width):
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sketches.append(found[:K])
            lengths = np.cumsum([0, *map(len, sketches)]).astype(np.int32)
            values = pa.array(np.concatenate(sketches) if sketches else np.zeros(0, dtype=np.int64))
            lists = pa.ListArray.from_arrays(pa.array(lengths), values)
            columns = [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", MARK, "n", "digest", "sketch"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, {MARK} long, n long, digest binary, sketch array<long>"
    return in_batches(docs.select("doc_id", "text", MARK), run, schema)


def classes(signed: DataFrame) -> DataFrame:
    """``doc_id``, ``MARK``, ``n``, ``least`` (smallest id with the same set), ``rep`` (names the set), ``sketch`` (of rows with the smallest id).

    ``rep`` is the smallest id too, but where an id is the smallest of several sets: of these only one is named by it, others by a hash.
    """
    smallest = stored(signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least")), "near_smallest")
    several = smallest.groupBy("least").agg(F.count("*").alias("sets"), F.min("digest").alias("first")).where("sets > 1").select("least", "first")
    named = smallest.join(several, "least", "left")
    rep = F.when(F.col("first").isNull() | (F.col("first") == F.col("digest")), F.col("least").cast("long")).otherwise(F.xxhash64("least", "digest"))
    joined = signed.join(named.select("digest", "least", rep.alias("rep")), "digest", "left")
    sketch = F.when(F.col("doc_id") == F.col("least"), F.col("sketch")).alias("sketch")
    return joined.select("doc_id", MARK, "n", "least", "rep", sketch)


def posted(reps: DataFrame) -> DataFrame:
    """``rep`` and ``value`` of the inverted lists: the rarest sketch values of each document that another document has too."""
    values = reps.select("rep", "n", F.explode("sketch").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    known = values.join(shared, "value").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("known"))
    size = F.least(F.col("n"), F.lit(K))
    # a set that is held whole shares at least 0.8 of itself; one near K may meet a set that is not
    least = F.when(F.col("n") * WHOLE <= K * PART, F.ceil(F.col("n") * PART / WHOLE)).otherwise(F.lit(LEAST_SHARED))
    alone = size - F.size("known")  # values that no other document has come first
    listed = F.greatest(F.lit(0), size - least + 1 - alone).cast("int")
    return known.select("rep", F.explode(F.slice("known", 1, listed)).alias("k")).select("rep", F.col("k.value").alias("value"))


def lists(post: DataFrame) -> DataFrame:
    """``value``, ``members`` of the lists to read: two members at least, one list of those with equal members."""
    marks = [F.bit_xor(F.xxhash64("rep")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("x2")]
    found = post.groupBy("value").agg(F.count("*").alias("members"), *marks).where("members > 1")
    return found.groupBy("members", "x1", "x2").agg(F.min("value").alias("value")).select("value", "members")


def estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of the sets behind two arrays of sketches (rows; padded), by the bottom-k sketches of their unions."""
    both = np.sort(np.concatenate((left, right), axis=1), axis=1)
    again = np.zeros(both.shape, dtype=bool)
    again[:, 1:] = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != PAD)
    distinct = np.cumsum(~again & (both != PAD), axis=1)
    shared = (again & (distinct <= K)).sum(axis=1)
    return shared / np.maximum(1, np.minimum(K, distinct[:, -1]))


def near_in_list(sketches: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the pairs of one list whose estimate allows a link."""
    n = len(sizes)
    compatible = lambda a, b: WHOLE * np.minimum(sizes[a], sizes[b]) >= PART * np.maximum(sizes[a], sizes[b])
    if n <= 32:
        left, right = np.triu_indices(n, 1)
        fits = compatible(left, right)
        left, right = left[fits], right[fits]
        near = estimates(sketches[left], sketches[right]) >= LEAST_ESTIMATE
        return Forest(n).spanning(left[near], right[near])
    # a search that compares each document it reaches with those not reached yet
    edges, unseen = [], np.arange(n)
    while len(unseen):
        frontier, unseen = [int(unseen[0])], unseen[1:]
        while frontier and len(unseen):
            here = frontier.pop()
            fits = unseen[compatible(np.full(len(unseen), here), unseen)]
            reached = fits[estimates(np.broadcast_to(sketches[here], (len(fits), K)), sketches[fits]) >= LEAST_ESTIMATE]
            if len(reached):
                edges += [(here, int(r)) for r in reached]
                frontier += reached.tolist()
                unseen = np.setdiff1d(unseen, reached, assume_unique=True)
    return edges


def padded(sketches: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists_ = sketches.combine_chunks() if isinstance(sketches, pa.ChunkedArray) else sketches
    offsets = lists_.offsets.to_numpy()
    lengths = np.diff(offsets)
    values = lists_.values.to_numpy()[offsets[0] : offsets[-1]]
    out = np.full((len(lengths), K), PAD, dtype=np.int64)
    out[np.arange(K) < lengths[:, None]] = values
    return out


def candidate_edges(reps: DataFrame, post: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` that connect all documents whose sketches allow a link."""
    listed = post.join(lists(post), "value").join(reps.select("rep", "n", "sketch"), "rep")
    n_blocks = F.ceil(F.col("members") / LIST_BLOCK).cast("int")
    block = F.pmod(F.xxhash64("rep"), n_blocks).cast("int")
    rows = listed.withColumn("pair", F.explode(block_pairs(block, n_blocks, inner=False))).select("value", "pair.i", "pair.j", "rep", "n", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, starts in whole_groups(batches, 3):
            ids, sizes, sketches = rows_.column(3).to_numpy(), rows_.column(4).to_numpy(), padded(rows_.column(5))
            edges = [(a + first, b + first) for first, last in zip(starts[:-1], starts[1:], strict=True) for a, b in near_in_list(sketches[first:last], sizes[first:last])]
            sides = contracted(ids[[a for a, _ in edges]], ids[[b for _, b in edges]]) if edges else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in sides], ["a", "b"])

    return by_groups(rows, ["value", "i", "j"], run, "a long, b long")


def links_in_cluster(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning forest of the pairs with the similarity, by full sets."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if len(sets) == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(0, 1)] if WHOLE * shared >= PART * (sizes.sum() - shared) else []
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared_by = counts > 1
    number = np.cumsum(shared_by) - 1
    kept = shared_by[column]
    owner, column = owner[kept], number[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for low in range(0, int(number[-1]) + 1, COLUMNS):
        first, last = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[owner[first:last], column[first:last] - low] = 1
        common += part @ part.T  # whole numbers below 2^24: exact
    common = common.astype(np.int64)
    left, right = np.nonzero(np.triu(WHOLE * common >= PART * (sizes[:, None] + sizes - common), 1))
    return Forest(len(sets)).spanning(left, right)


def linked(docs: DataFrame, clusters: DataFrame, width: int) -> DataFrame:
    """Edges ``a``, ``b`` (the smaller one) that connect all linked documents of each cluster. ``clusters``: ``rep``, ``least``, ``MARK``, ``n``, ``cluster``.

    ``whole`` says that the cluster is one block, so ``b`` is the smallest document of the component already.
    """
    sizes = clusters.groupBy("cluster").agg(F.sum("n").alias("shingles"), F.count("*").alias("documents"))
    members = stored(clusters.join(sizes, "cluster"), "near_members")
    texts = docs.where("doc_id IS NOT NULL").join(members.select(F.col("least").alias("doc_id")), "doc_id", "left_semi")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([s.tobytes() for s in shingle_sets(batch.column(1), width)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), sets], ["least", MARK, "shingles_of"])

    sets = in_batches(texts.select("doc_id", "text", MARK), make, f"least long, {MARK} long, shingles_of binary").dropDuplicates(["least", MARK])
    n_blocks = F.greatest(F.ceil(F.col("shingles") / CLUSTER_BLOCK), F.ceil(F.col("documents") / CLUSTER_DOCUMENTS)).cast("int")
    block = F.pmod(F.xxhash64("rep"), n_blocks).cast("int")
    rows = members.join(sets, ["least", MARK]).withColumns({"blocks": n_blocks, "pair": F.explode(block_pairs(block, n_blocks, inner=False))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_, starts in whole_groups(batches, 3):
            ids, blocks = rows_.column(3).to_numpy(), rows_.column(4).to_numpy()
            sets_ = [np.frombuffer(s, dtype=np.int64) for s in rows_.column(5).to_pylist()]
            nodes, least, whole = [], [], []
            for first, last in zip(starts[:-1], starts[1:], strict=True):
                own = ids[first:last]
                edges = links_in_cluster(sets_[first:last]) if last - first > 1 else []
                if edges:
                    a, b = contracted(own[[x for x, _ in edges]], own[[y for _, y in edges]])
                    nodes, least, whole = nodes + a, least + b, whole + [bool(blocks[first] == 1)] * len(a)
            columns = [pa.array(nodes, pa.int64()), pa.array(least, pa.int64()), pa.array(whole, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "whole"])

    columns = ["cluster", "pair.i", "pair.j", "rep", "blocks", "shingles_of"]
    return by_groups(rows.select(columns), ["cluster", "i", "j"], run, "a long, b long, whole boolean", 256)


def grouped(docs: DataFrame, width: int) -> DataFrame:
    """Per document ``doc_id``, ``MARK``, ``n_shingles``, ``component_id``, ``kept``, ``group`` (names its component, NULL with an empty set)."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias(MARK))
    known = stored(classes(signatures(docs, width)), "near_classes")
    reps = known.where("sketch IS NOT NULL").select("rep", "least", MARK, "n", "sketch").dropDuplicates(["rep"])
    post = stored(posted(reps), "near_posted")
    clusters = components(candidate_edges(reps, post), "near_clusters")
    clusters = clusters.join(reps.drop("sketch"), F.col("node") == F.col("rep")).select("rep", "least", MARK, "n", F.col("component").alias("cluster"))
    links = stored(linked(docs, clusters, width), "near_links")
    found = components(links.where("NOT whole"), "near_groups").union(links.where("whole").select("a", "b"))
    found = stored(found.union(found.select("component", "component")).distinct(), "near_found")
    # the smallest node of a component names it; its smallest id may be that of another node, as some are hashes
    ids = found.join(reps.select("rep", "least"), F.col("node") == F.col("rep")).groupBy("component").agg(F.min("least").alias("smallest"))
    joined = known.join(found.join(ids, "component"), F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "least", "doc_id"))
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    group = F.coalesce("component", "rep").alias("group")
    return joined.select("doc_id", MARK, F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"), group)


def near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """Per document ``doc_id``, ``n_shingles``, ``component_id``, ``kept``; links have a similarity of ``PART`` / ``WHOLE`` at least."""
    return grouped(docs, width).select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame, width: int = 5) -> DataFrame:
    """The documents, with all their columns, that ``near_duplicates`` keeps.

    Of rows with the same id those with different texts stay unless their sets are linked; rows without id all stay.
    """
    found = stored(grouped(docs, width).select("doc_id", MARK, "kept", "group"), "near_grouped")
    marked = docs.withColumn(MARK, F.xxhash64("text"))
    keys = ["doc_id", MARK]
    left = marked.join(found.where("NOT kept").select(keys).distinct(), keys, "left_anti")
    repeated = docs.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    once = left.join(repeated, "doc_id", "left_anti")
    several = found.where("kept").join(repeated, "doc_id", "left_semi")
    one = several.groupBy("doc_id", F.coalesce("group", MARK).alias("group")).agg(F.min(MARK).alias(MARK)).select(keys).distinct()
    rest = left.join(one, keys, "left_semi").dropDuplicates(keys)
    return once.select(*docs.columns).union(rest.select(*docs.columns))
