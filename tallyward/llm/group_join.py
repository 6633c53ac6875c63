"""Near-duplicate texts by an exact Jaccard join over a token-group matrix.

Tokens are 64-bit hashes of word shingles. A token found in one set only cannot belong to any intersection, so a first
shuffle of bare tokens finds in how many sets each occurs; a set of which too few tokens are shared is settled. The
remaining distinct sets are partitioned into groups of similar ones, each at most ``GROUP`` sets. The matrix holds each
group's token union. Links inside groups come first; then a set is a query against another group only if they share a
token of its prefix (by rising frequency), its overlap with the group's union reaches the bound, and the two are not
connected yet; only then the group is opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import mix, partitions, pick, release, slices, stage, text_bytes, windows, words_of
from tallyward.llm.components import Forest, components

GROUP = 256
SLICE = 32 << 20
QUERIES_AT_ONCE = 512

_U8 = np.dtype("<u8")


def shingle_sets(flat: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text joined, and where each text's set starts."""
    begin, end, code, first = words_of(flat, starts, fold=True)
    n = len(starts) - 1
    key, at = windows(code, first, width)
    owner = np.repeat(np.arange(n), np.diff(first))
    counts = np.bincount(owner[at], minlength=n)
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < width))
    if len(few):
        # The whole sequence as one shingle; its length is part of the hash.
        whole = np.array([_sequence(code[first[i]:first[i + 1]]) for i in few], np.uint64)
        key = np.insert(key, np.r_[0, np.cumsum(counts)][few], whole)
        counts[few] = 1
    bounds = np.r_[0, np.cumsum(counts)]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        key[a:b].sort()
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    fresh[bounds[:-1][counts > 0]] = True
    return key[fresh], np.r_[0, np.cumsum(fresh)][bounds]


def _sequence(code: np.ndarray) -> np.uint64:
    total = np.uint64(len(code))
    for c in code:
        total = mix(np.array([total ^ c], np.uint64))[0]
    return total


def _signatures(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums per set: equal sets have equal ones."""
    one = np.r_[np.uint64(0), np.cumsum(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)))]
    two = np.r_[np.uint64(0), np.cumsum(mix(tokens + np.uint64(0x14057B7EF767814F)))]
    return (one[bounds[1:]] - one[bounds[:-1]]).view(np.int64), (two[bounds[1:]] - two[bounds[:-1]]).view(np.int64)


# Rows of the token shuffle: kind 0 has tokens of one block for one slice, kind 1 the documents of one block.
_DEALT = "kind int, slice int, block long, tokens binary, places binary, extra binary, doc_ids array<long>"


def _deal(batches: Iterator[pa.RecordBatch], width: int, n_slices: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for seq, batch in enumerate(slices(batches, "text", 2 << 20)):
        block = part << 24 | seq
        tokens, bounds = shingle_sets(*text_bytes(batch.column(1)), width)
        one, two = _signatures(tokens, bounds)
        sizes = np.diff(bounds)
        _, first = np.unique(np.stack([one, two, sizes]), axis=1, return_index=True)
        sends = np.zeros(len(sizes), bool)
        sends[first] = True
        named = batch.column(2).to_numpy(zero_copy_only=False)
        info = np.stack([sizes, one, two, named]).astype("<i8").tobytes()
        rows = [(1, block % n_slices, block, b"", b"", info, batch.column(0).to_pylist())]
        owner = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
        sent = sends[owner]
        tokens, owner = tokens[sent], owner[sent]
        to = (tokens >> np.uint64(40)) % np.uint64(n_slices)
        order = np.argsort(to, kind="stable")
        tokens, owner = tokens[order], owner[order]
        cuts = np.searchsorted(to[order], np.arange(n_slices + 1, dtype=np.uint64))
        rows += [(0, i, block, tokens[a:b].tobytes(), owner[a:b].tobytes(), b"", None)
                 for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
        yield _batch(rows, _DEALT)


_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(),
          "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(columns, fields, strict=True)],
                                      names=[n for n, _ in fields])


def _table(rows: list[tuple], schema: str) -> pa.Table:
    if len(rows) > 1000:  # not after every small group
        release()
    return pa.Table.from_batches([_batch(rows, schema)])


def _numbers(column: pa.ChunkedArray, i: int, dtype: np.dtype) -> np.ndarray:
    """The numbers in a binary value, read where they lie."""
    data = column[i].as_buffer()
    return np.frombuffer(data, dtype) if data.size else np.zeros(0, dtype)


def _shared(table: pa.Table) -> pa.Table:
    """Of one slice: the tokens found in two sets or more, back by block, with the number of sets that have each."""
    kinds, blocks = table.column("kind").to_numpy(), table.column("block").to_numpy()
    slice_ = table.column("slice")[0].as_py()
    dealt, places = table.column("tokens"), table.column("places")
    heads = table.select(["block", "extra", "doc_ids"]).filter(pa.array(kinds == 1)).to_pylist()
    out = [(1, slice_, r["block"], b"", b"", r["extra"], r["doc_ids"]) for r in heads]
    at = np.flatnonzero(kinds == 0).tolist()
    if at:
        # Only the dealt tokens and one sorted copy of them are in memory at a time.
        ordered = np.concatenate([_numbers(dealt, i, _U8) for i in at])
        ordered.sort()
        same = ordered[1:] == ordered[:-1]
        begins = np.flatnonzero(same & np.r_[True, ~same[:-1]]) if len(same) else np.zeros(0, np.int64)
        ends = np.flatnonzero(same & np.r_[~same[1:], True]) if len(same) else begins
        common, counts = ordered[begins], (ends - begins + 2).astype("<u4")
        del ordered, same, begins, ends
        for i in at if len(common) else []:
            own = _numbers(dealt, i, _U8)
            place = np.minimum(np.searchsorted(common, own), len(common) - 1)
            hit = common[place] == own
            if hit.any():
                out.append((0, slice_, int(blocks[i]), own[hit].tobytes(), _numbers(places, i, np.uint32)[hit].tobytes(),
                            counts[place[hit]].tobytes(), None))
    release()
    return _table(out, _DEALT)


_SETS = "gid long, doc_id long, text_hash long, n long, one long, two long, home long, n_prefix int, tokens binary"


def _assemble(percent: int):
    def work(table: pa.Table) -> pa.Table:
        """Of one block: its documents, those that may have a link with their shared tokens by rising frequency."""
        rows = table.to_pylist()
        head = next(r for r in rows if r["kind"] == 1)
        sizes, one, two, named = np.frombuffer(head["extra"], "<i8").reshape(4, -1)
        rows = [r for r in rows if r["kind"] == 0]
        tokens = np.concatenate([np.frombuffer(r["tokens"], _U8) for r in rows] or [np.zeros(0, _U8)])
        owner = np.concatenate([np.frombuffer(r["places"], np.uint32) for r in rows] or [np.zeros(0, np.uint32)])
        counts = np.concatenate([np.frombuffer(r["extra"], "<u4") for r in rows] or [np.zeros(0, "<u4")])
        shared = np.bincount(owner, minlength=len(sizes))
        active = (shared > 0) & (100 * shared >= percent * sizes)
        keep = active[owner]
        tokens, owner, counts = tokens[keep], owner[keep], counts[keep]
        order = np.lexsort((tokens, counts, owner))
        tokens, counts = tokens[order], counts[order]
        bounds = np.searchsorted(owner[order], np.arange(len(sizes) + 1))
        out = []
        for i, doc_id in enumerate(head["doc_ids"]):
            home = n_prefix = own = None
            if active[i]:
                a, b = int(bounds[i]), int(bounds[i + 1])
                # The most shared token that is not much more frequent than usual here: copies have it in common.
                usual = counts[a + (b - a) // 2]
                home = int(tokens[a + np.searchsorted(counts[a:b], 2 * usual, "right") - 1].astype(np.int64))
                n_prefix = int((b - a) - -(-percent * int(sizes[i]) // 100) + 1)
                own = tokens[a:b].tobytes()
            out.append((head["block"] << 20 | i, doc_id, int(named[i]), int(sizes[i]), int(one[i]), int(two[i]), home,
                        n_prefix, own))
        return _table(out, _SETS)

    return work


class Group:
    """Sets of one group with their token union, as arrays."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int], percent: int):
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), list(map(len, sets)))
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owner = tokens[order], owner[order]
        self.union, self.first = np.unique(self.tokens, return_index=True)
        self.counts = np.diff(np.r_[self.first, len(tokens)])
        self.sizes, self.percent = np.array(sizes), percent

    def linked(self, query: np.ndarray, size: int) -> np.ndarray:
        """Members that link with the query; empty at once where its overlap with the union is below the bound."""
        place = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        place = place[self.union[place] == query]
        if 100 * len(place) < self.percent * size:
            return np.zeros(0, np.int64)
        counts = self.counts[place]
        at = np.repeat(self.first[place] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        common = np.bincount(self.owner[at], minlength=len(self.sizes))
        return np.flatnonzero((100 * common >= self.percent * (self.sizes + size - common)) & (common > 0))


_LABELS, _LINKS = "gid long, label long", "a long, b long"


def _inside(percent: int):
    def work(table: pa.Table) -> pa.Table:
        """The smallest gid that each set reaches by links inside one group, where it is another. The pivot is the smallest
        of its home and the only set in several groups, so these are the components of the links inside all groups.
        Sets linked with the pivot need no further search: a link between them adds nothing, and all other sets look
        for theirs."""
        gids = table.column("gid").to_pylist()
        sets = [np.frombuffer(x, _U8) for x in table.column("tokens").to_pylist()]
        order = sorted(range(len(gids)), key=gids.__getitem__)
        gids, sets = [gids[i] for i in order], [sets[i] for i in order]
        sizes = [table.column("n")[i].as_py() for i in order]
        group, forest = Group(sets, sizes, percent), Forest(len(gids))
        for i in range(len(gids)):
            if i and forest.find(i) == 0:
                continue
            for j in group.linked(sets[i], sizes[i]).tolist():
                forest.join(i, j)
        roots = map(forest.find, range(len(gids)))
        return _table([(gids[i], gids[root]) for i, root in enumerate(roots) if i != root], _LABELS)

    return work


def _opened(percent: int):
    def work(table: pa.Table) -> pa.Table:
        """Links between the components of the queries and those of one group's members."""
        rows = table.select(["n", "label", "is_query", "tokens"]).to_pylist()
        members = [r for r in rows if not r["is_query"]]
        group = Group([np.frombuffer(r["tokens"], _U8) for r in members], [r["n"] for r in members], percent)
        out = set()
        for r in rows:
            if r["is_query"]:
                linked = group.linked(np.frombuffer(r["tokens"], _U8), r["n"]).tolist()
                out |= {(r["label"], members[j]["label"]) for j in linked if members[j]["label"] != r["label"]}
        return _table(sorted(out), _LINKS)

    return work


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after links between them."""
    found = components(links).select(F.col("node").alias("label"), F.col("label").alias("place"))
    return labels.join(found, "label", "left").select("gid", F.coalesce("place", "label").alias("label"))


def _bounded(prefixes: DataFrame, percent: int) -> DataFrame:
    """The rows of a token at which their set could link with another.

    Two sets of sizes n and m link when (100 + percent) * overlap >= percent * (n + m). At their first common token, in
    the order of all prefixes, the overlap is at most what either set has left from there (``rest``). So a row of a
    token stays only if, by the largest rest and the smallest size of the token's rows, some other row could link with
    it there; what texts share a passage and still cannot link goes before any join.
    """
    # What is left of a row's bound for the size of a partner.
    spare = (100 + percent) * F.col("rest") - percent * F.col("n")
    reach = prefixes.groupBy("token").agg(F.max(spare).alias("most"), F.min("n").alias("least"))
    return stage(prefixes.join(reach, "token").where(
        (percent * F.col("n") <= F.col("most")) & (percent * F.col("least") <= spare)).drop("most", "least"), "jaccard-bounded")


def _across(reps: DataFrame, rows: DataFrame, labels: DataFrame, percent: int, narrow: bool) -> tuple[DataFrame, ...]:
    """The rows whose tokens are in two components or more (labels only join, so no later search needs the others), the
    labels as a table, and links between labels.

    In the full search every set asks each group of another component with which it shares a token of
    their prefixes and whose bound allows a link (the sets of the smaller component ask the groups of the larger one),
    which finds every link. The narrow search goes before it: per token, one set of each component asks one group of the
    largest. It joins most of what belongs together, so that the full search has few pairs left.
    """
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_label"))
    labels = stage(labels.join(sizes, "label"), "jaccard-labels")
    rows = rows.join(labels, "gid")
    several = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    rows = stage(rows.join(several.select("token"), "token", "left_semi"), "jaccard-across")
    if narrow:
        largest = rows.groupBy("token").agg(F.max(F.struct("n_label", "label", "home", "part")).alias("to"))
        asking = rows.groupBy("token", "label").agg(F.min("gid").alias("gid")).join(largest, "token")
        asked = asking.where(F.col("label") != F.col("to.label")).select("gid", "to.home", "to.part")
    else:
        groups = rows.groupBy("token", "home", "part", F.col("label").alias("to_label"), F.col("n_label").alias("to_size")).agg(
            F.max("rest").alias("to_rest"), F.min("n").alias("to_n"))
        smaller = F.struct("n_label", "label") < F.struct("to_size", "to_label")
        could = (100 + percent) * F.least("rest", "to_rest") >= percent * (F.col("n") + F.col("to_n"))
        asked = rows.select("token", "gid", "label", "n_label", "n", "rest").join(groups, "token").where(
            smaller & could).select("gid", "home", "part")
    asked = stage(asked.distinct(), "jaccard-asked")

    turns = asked.groupBy("home", "part").agg(F.expr(
        f"(count(1) + {QUERIES_AT_ONCE - 1}) div {QUERIES_AT_ONCE}").alias("n_turns"))
    content = reps.select("gid", "home", "part", "n", "tokens").join(labels.select("gid", "label"), "gid")
    asking = asked.join(turns, ["home", "part"]).withColumn("turn", F.expr("pmod(xxhash64(gid), n_turns)")).join(
        content.drop("home", "part"), "gid").select(
        "home", "part", "turn", "gid", "n", "label", F.lit(True).alias("is_query"), "tokens")
    answering = content.join(turns, ["home", "part"]).select(
        "home", "part", F.explode(F.expr("sequence(0, n_turns - 1)")).alias("turn"), "gid", "n", "label",
        F.lit(False).alias("is_query"), "tokens")
    found = asking.unionAll(answering).groupBy("home", "part", "turn").applyInArrow(_opened(percent), _LINKS)
    return rows.drop("label", "n_label"), labels.select("gid", "label"), stage(found, "jaccard-found")


def jaccard_classes(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, text_hash, n_shingles, class_id, component_id, first)``, one row per row of ``documents``.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; a text's set holds its distinct shingles of
    ``width`` words (with fewer words the whole sequence). Two texts link when ``100 * intersection >= percent *
    union``. ``class_id`` is equal exactly for equal sets; ``component_id`` is the smallest doc_id reachable by links,
    itself included; ``first`` marks one row of each component, and ``text_hash`` is ``xxhash64`` of its text. A null or empty text, or one without words, has an
    empty set and is alone. Null ids take part but are never the smallest unless all of a component are null; repeated
    rows are equal sets. An empty table has no result.
    """
    spark = documents.sparkSession
    rows = pick(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                                    F.xxhash64("text").alias("text_hash"))
    # A slice of tokens is one group of a task: about SLICE bytes of text, twice that in tokens and places.
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()["size"]
    n_slices = max(partitions(spark), -(-size // SLICE))
    dealt = rows.mapInArrow(lambda batches: _deal(batches, width, n_slices), _DEALT)
    shared = dealt.groupBy("slice").applyInArrow(_shared, _DEALT)
    sets = stage(shared.groupBy("block").applyInArrow(_assemble(percent), _SETS), "jaccard-sets")

    same = ["n", "one", "two"]
    classes = sets.where("n > 0").groupBy(*same).agg(F.min("gid").alias("rep"))
    reps = sets.where("tokens IS NOT NULL").select("gid", "n", "home", "n_prefix", "tokens")
    reps = reps.join(classes.select(F.col("rep").alias("gid")), "gid", "left_semi")
    homes = reps.groupBy("home").agg(F.count(F.lit(1)).alias("n_home"), F.min("gid").alias("pivot"))
    homes = homes.withColumn("n_groups", F.expr(f"(n_home + {GROUP - 1}) div {GROUP}"))
    reps = stage(reps.join(homes, "home").withColumn("part", F.expr("pmod(xxhash64(gid), n_groups)")), "jaccard-reps")

    # Groups: the sets of a home, dealt to parts; the pivot of the home is a member of every part.
    alike = reps.where("n_home > 1")
    pivots = alike.where("gid = pivot AND n_groups > 1").select(
        "home", F.explode(F.expr("sequence(0, n_groups - 1)")).alias("to"), "part", "gid", "n", "tokens")
    members = alike.select("home", "part", "gid", "n", "tokens").unionAll(
        pivots.where("to <> part").select("home", F.col("to").alias("part"), "gid", "n", "tokens"))
    inside = stage(members.groupBy("home", "part").applyInArrow(_inside(percent), _LABELS), "jaccard-inside")

    token = F.explode(F.expr("transform(sequence(1, n_prefix), i -> struct(substring(tokens, i * 8 - 7, 8) AS token, "
                             "length(tokens) div 8 - i + 1 AS rest))"))
    prefixes = stage(reps.select("gid", "home", "part", "n", token.alias("one")).select(
        "gid", "home", "part", "n", "one.token", "one.rest"), "jaccard-prefixes")
    rows = _bounded(prefixes, percent)
    labels = reps.select("gid").join(inside, "gid", "left").select("gid", F.coalesce("label", "gid").alias("label"))
    for narrow in (True, False):
        rows, labels, links = _across(reps, rows, labels, percent, narrow)
        labels = _joined(labels, links)
    final = labels.withColumnRenamed("gid", "rep")
    found = classes.join(final, "rep", "left").select(
        *same, "rep", F.coalesce("label", "rep").alias("label"))
    placed = sets.select("gid", "doc_id", "text_hash", *same).join(found, same, "left")
    placed = placed.withColumn("label", F.coalesce("label", "gid"))
    least = placed.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "gid")).alias("least"))
    return placed.join(least, "label").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("rep", "gid").alias("class_id"),
        F.col("least.doc_id").alias("component_id"), (F.col("gid") == F.col("least.gid")).alias("first"))


def keep_first(documents: DataFrame, columns: tuple[str, ...], **options) -> DataFrame:
    """The named columns of one document of each component (the one of smallest doc_id, null ids last).

    A document is an id and a text: rows that repeat both are one document, rows of one id (or without an id) with other
    texts are others, and the text that was chosen is the one that stays.
    """
    kept = jaccard_classes(documents, **options).where("first").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    rows = pick(documents, *dict.fromkeys(("doc_id", "text", *columns))).withColumn("__text", F.xxhash64("text"))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash")), "left_semi")
    again = Window.partitionBy("doc_id", "__text").orderBy(F.lit(1))
    return rows.withColumn("__again", F.row_number().over(again)).where("__again = 1").select(*columns)
