"""Exact Jaccard joins of token sets, shared by the line and the document operators.

1. Items with equal sets are one set, known by the hash of its tokens.
2. Screen. Tokens are ordered by hash. Of two sets of a Jaccard of t or more, the first n - ceil(t n) + l tokens of
   both share l at least, so a set stays only if that many of its first tokens stand in another set as well. The pass
   that takes the sets keeps these tokens, so texts are not read again for it. A set so small that no other set can
   come near it takes no part. Tasks sort the tokens by bucket, and what they find in several sets goes on once.
3. Among the sets left, tokens are ordered by rarity. Tokens of one set only count towards n and nothing else; a
   set with too many of them has no partner and goes.
4. Sets that share a prefix token form families, by a star to the smallest set of each token.
5. A family is cut into blocks of bounded size and each pair of blocks is one group of work: prefix index, needed
   matches, length and position filters, then the exact intersection. A group gives counts and a spanning forest of
   its links, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybook.llm.common import U64, list_array, mixed, written

#: Tokens of a block; a pair of blocks is held by one task.
BLOCK_TOKENS = 400_000
#: Tokens, on average, of the small families that are one group of work together.
PACK_TOKENS = 50_000
#: Edges of a file of the tables that ``components`` writes.
EDGES_PER_FILE = 500_000
#: Tokens, on average, of the sets of a bucket.
BUCKET_TOKENS = 1 << 18
#: Tokens that a task sorts into buckets at once.
SORTED_TOKENS = 1 << 20
#: Part of a set by which the screen's prefix is longer than the plain one.
SCREEN_EXTRA = 1 / 12

#: Gives, for a batch, (row of the batch, part of the row, owner of each token, tokens): the last two ascending.
Sets = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]
#: Gives texts with what holds the wanted parts only, from the texts and each one's list of parts.
Cut = Callable[[pa.Array, pa.Array], pa.Array]


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that a set of n shares at least with any partner."""
    return -(-percent * n // 100)


def has_partners(n: np.ndarray, percent: int) -> np.ndarray:
    """Whether a set of n can be linked with another one at all: at best with one that has a token more."""
    return 100 * n >= percent * (n + 1)


def set_ids(tokens: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(n), U64)
    if len(tokens):
        some = np.flatnonzero(n)
        sums[some] = np.add.reduceat(mixed(tokens ^ U64(0xA0761D6478BD642F)), first[some])
    return mixed(sums + n.astype(U64)).view(np.int64)


def _counted(owner: np.ndarray, items: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.bincount(owner, minlength=items)
    return n, np.cumsum(n) - n


def items(rows: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """``doc_id, part, n, set_id`` of every item of ``doc_id, text``, and of those that send it the screen's prefix.

    Of the items of one set in an Arrow batch the first sends it, the others an empty one.
    """

    def run(batches):
        for batch in batches:
            seen: set[int] = set()
            for row, part, owner, tokens in sets(batch):
                n, first = _counted(owner, len(row))
                ids = set_ids(tokens, first, n)
                fresh = np.array([i not in seen and not seen.add(i) for i in ids.tolist()], bool)
                length = np.where(fresh & has_partners(n, percent), _screen_length(n, percent)[0], 0)
                inside = np.arange(len(tokens)) - first[owner] < length[owner]
                prefix = list_array(tokens[inside].view(np.int64), owner[inside], len(row), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(part), pa.array(n), pa.array(ids), pa.array(length > 0), prefix],
                    ["doc_id", "part", "n", "set_id", "sends", "prefix"],
                )

    return rows.mapInArrow(run, "doc_id long, part long, n long, set_id long, sends boolean, prefix array<long>")


def _screen_length(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Length of the screen's prefix, and the matches that it must have."""
    extra = lambda m: np.maximum(1, (m * SCREEN_EXTRA).astype(np.int64))
    partner = needed(n, percent)  # the smallest set that can be a partner
    return np.minimum(n, n - needed(n, percent) + extra(n)), np.minimum(extra(n), extra(np.maximum(partner, 1)))


def _elsewhere(tokens: np.ndarray, sets: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending tokens, which are of several sets or ``known`` to be, and which of the distinct ones are."""
    first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])[: len(tokens)])
    if not len(first):
        return np.zeros(0, bool), np.zeros(0, bool)
    several = np.minimum.reduceat(sets, first) != np.maximum.reduceat(sets, first)
    several |= np.isin(tokens[first], known)
    return np.repeat(several, np.diff(np.append(first, len(tokens)))), several


#: Rows of the screen: tokens and their sets; tokens known to be of several sets; sets and their matches.
OPEN, KNOWN, SETTLED = 0, 1, 2


def _buckets(tokens: int) -> int:
    """The bits that number the buckets of so many tokens."""
    return max(1, (tokens // BUCKET_TOKENS).bit_length())


def _dealt(kind: int, by: np.ndarray, bits: int, *columns: np.ndarray) -> pa.RecordBatch:
    """``bucket, kind`` and lists of the columns, a row for each of the buckets of ``by``, which ascends."""
    bucket = (by >> U64(64 - bits)).view(np.int64)
    filled, owner = np.unique(bucket, return_inverse=True)
    lists = [list_array(x.view(np.int64), owner[: len(x)], len(filled), pa.int64()) for x in columns]
    kinds = pa.array(np.full(len(filled), kind))
    return pa.RecordBatch.from_arrays([pa.array(filled), kinds, *lists], ["bucket", "kind", *"abc"[: len(lists)]])


def _gathered(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], int]) -> Iterator[list[pa.RecordBatch]]:
    """Batches of about ``SORTED_TOKENS`` tokens at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += size(batch)
        if n >= SORTED_TOKENS:
            yield held
            held, n = [], 0
    if held:
        yield held


def _bucketed(batches: list[pa.RecordBatch], bits: int) -> list[pa.RecordBatch]:
    """The prefixes of ``set_id, prefix`` by bucket of their tokens, those of several sets settled here.

    Such a token's sets have their match, and other tasks need its name only, so no token brings a row of each set.
    """
    lists = [(batch.column(0).to_numpy(), batch.column(1)) for batch in batches]
    sets = np.concatenate([np.repeat(ids, np.diff(own.offsets.to_numpy())) for ids, own in lists])
    tokens = mixed(np.concatenate([own.flatten().to_numpy() for _, own in lists]).view(U64))  # prefixes hold small ones
    order = np.argsort(tokens)
    tokens, sets = tokens[order], sets[order]
    here, several = _elsewhere(tokens, sets, tokens[:0])
    known = tokens[np.append(True, tokens[1:] != tokens[:-1])[: len(tokens)]][several]
    found, matches = np.unique(sets[here], return_counts=True)
    spread = mixed(found.view(U64))
    order = np.argsort(spread)
    return [
        _dealt(OPEN, tokens[~here], bits, tokens[~here], sets[~here]),
        _dealt(KNOWN, known, bits, known, known[:0]),
        _dealt(SETTLED, spread[order], bits, found[order], matches[order]),
    ]


def screened(item_rows: DataFrame) -> DataFrame:
    """``set_id, matches``: the tokens of the sets' prefixes that stand in another set, over all items that send them."""
    sent = item_rows.where("sends")
    bits = _buckets(sent.agg(F.sum("n")).first()[0] or 0)

    def deal(batches):
        for held in _gathered(batches, lambda batch: len(batch.column(1).flatten())):
            yield from _bucketed(held, bits)

    def settle(table: pa.Table) -> pa.Table:
        part = lambda kind, name: table.filter(pc.equal(table["kind"], kind))[name].combine_chunks().flatten().to_numpy()
        tokens, sets = part(OPEN, "a"), part(OPEN, "b")
        order = np.argsort(tokens)
        here, _ = _elsewhere(tokens[order], sets[order], part(KNOWN, "a"))
        found, matches = np.unique(sets[order][here], return_counts=True)
        ids = np.concatenate([found, part(SETTLED, "a")])
        return pa.table({"set_id": ids, "matches": np.concatenate([matches, part(SETTLED, "b")])})

    dealt = sent.select("set_id", "prefix").mapInArrow(deal, "bucket long, kind long, a array<long>, b array<long>")
    settled = dealt.groupBy("bucket").applyInArrow(settle, "set_id long, matches long")
    return settled.groupBy("set_id").agg(F.sum("matches").alias("matches"))


def survivors(item_rows: DataFrame, matches: DataFrame, percent: int) -> DataFrame:
    """``set_id, n, copies, doc_id, part``: each set left, how many items have it, and the first of them.

    All items that send one set's prefix match alike, so a set's matches are those of one item times their number.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "part")).alias("first")
    grouped = item_rows.where("n > 0").groupBy("set_id").agg(
        F.max("n").alias("n"), F.count("*").alias("copies"), F.count_if("sends").alias("senders"), first
    )
    partner = F.ceil(F.col("n") * percent / 100)
    extra = lambda m: F.greatest(F.lit(1), F.floor(m * F.lit(SCREEN_EXTRA)))
    need = F.least(extra(F.col("n")), extra(F.greatest(partner, F.lit(1))))
    return (
        grouped.join(matches.hint("shuffle_hash"), "set_id")
        .where(F.col("matches") >= need * F.col("senders"))
        .select("set_id", "n", "copies", F.col("first.doc_id").alias("doc_id"), F.col("first.part").alias("part"))
    )


def token_table(rows: DataFrame, sets: Sets, left: DataFrame, cut: Cut | None = None) -> DataFrame:
    """``set_id, tokens`` of the sets left, taken again from the rows that hold them first; no other set is sent.

    A row is known by its id and its text's checksum, so the list that it meets has sets of such a text only. Where a
    row holds many sets, ``cut`` leaves of its text what holds the wanted ones.
    """
    # by shuffle at any size, as the ids grow with the corpus; hashed, so that no text is sorted
    checksum = F.col("part").bitwiseAND(0xFFFFFFFF)
    wanted = left.groupBy(F.col("doc_id").alias("at"), checksum.alias("checksum")).agg(
        F.collect_list("set_id").alias("sets"), *([F.collect_list("part").alias("parts")] if cut else [])
    )
    same = rows["doc_id"].eqNullSafe(F.col("at")) & (F.crc32(rows["text"].cast("binary")) == F.col("checksum"))
    here = rows.join(wanted.hint("shuffle_hash"), same).select(rows["doc_id"], rows["text"], *wanted.columns[2:])

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            if cut:
                texts = cut(batch.column(1), batch.column(3))
                batch = pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])
            for row, _, owner, tokens in sets(batch):
                n, first = _counted(owner, len(row))
                ids = set_ids(tokens, first, n)
                asked = lists.take(pa.array(np.unique(row))).flatten().to_numpy()
                keep = np.isin(ids, asked)
                _, place = np.unique(ids, return_index=True)
                once = np.zeros(len(ids), bool)
                once[place] = True
                keep &= once
                inside = keep[owner]
                number = np.cumsum(keep) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[keep]),
                        list_array(tokens[inside].view(np.int64), number[owner[inside]], int(keep.sum()), pa.int64()),
                    ],
                    ["set_id", "tokens"],
                )

    found = here.mapInArrow(run, "set_id long, tokens array<long>")
    return found.groupBy("set_id").agg(F.any_value("tokens").alias("tokens"))


def _matches_asked(n: int, alone: int, frequency: np.ndarray, percent: int) -> tuple[int, int]:
    """The multi-match level of the least estimated cost, and its prefix among the shared tokens.

    At level l a candidate uses up l entries of the prefix's lists at least, so there are sum(df - 1) / l of them
    at most, each verified at the cost of n; reading the lists costs sum(df).
    """
    most = needed(np.array([n]), percent)[0]
    plain = n - most - alone
    sums = np.concatenate([[0], np.cumsum(frequency)])
    best = (math.inf, 1, 0)
    level = 1
    while level <= most:
        length = min(max(plain + level, 0), len(frequency))
        entries = sums[length]
        cost = entries + n * (entries - length) / level
        best = min(best, (float(cost), level, length))
        level *= 2
    return best[1], best[2]


def ordered(tokens: DataFrame, left: DataFrame, percent: int, adaptive: bool) -> DataFrame:
    """The sets with their shared tokens, the rarest first, the level ``asks`` and its ``prefix``."""
    # one shuffle for the count and the join, as both read the same columns of it
    single = tokens.select("set_id", F.explode("tokens").alias("token")).repartition("token")
    shared = single.groupBy("token").agg(F.count("set_id").alias("df")).where("df > 1")
    # hashed rather than sorted: the tokens' rows are many, those of shared tokens fewer
    single = single.join(shared.hint("shuffle_hash"), "token").select("set_id", "df", "token")
    bits = _buckets(left.agg(F.sum("n")).first()[0] or 0)

    def deal(batches):
        for held in _gathered(batches, lambda batch: batch.num_rows):
            sets, df, token = (np.concatenate([batch.column(k).to_numpy() for batch in held]) for k in range(3))
            spread = mixed(sets.view(U64))
            order = np.argsort(spread)
            yield _dealt(0, spread[order], bits, sets[order], df[order], token[order])

    def listed(table: pa.Table) -> pa.Table:
        sets, df, token = (table[name].combine_chunks().flatten().to_numpy() for name in "abc")
        order = np.lexsort((token, df, sets))
        own, owner = np.unique(sets[order], return_inverse=True)
        df, token = (list_array(x[order], owner, len(own), pa.int64()) for x in (df, token))
        return pa.table({"set_id": pa.array(own), "df": df, "token": token})

    # sorted in tasks by bucket of sets: a group of its own for each set costs more than its few tokens
    dealt = single.mapInArrow(deal, "bucket long, kind long, a array<long>, b array<long>, c array<long>")
    lists = dealt.groupBy("bucket").applyInArrow(listed, "set_id long, df array<long>, token array<long>")
    lists = lists.join(left.select("set_id", "n", "copies", "doc_id", "part").hint("shuffle_hash"), "set_id").select(
        "set_id", "n", "copies", "doc_id", "part", "df", "token"
    )

    def run(batches):
        for batch in batches:
            n = batch.column(1).to_numpy()
            frequency = batch.column(5)
            shared = np.diff(frequency.offsets.to_numpy()).astype(np.int64)
            if adaptive:
                told = (
                    _matches_asked(int(n[i]), int(n[i] - shared[i]), frequency[i].values.to_numpy(), percent)
                    for i in range(batch.num_rows)
                )
                level, length = np.array(list(told), np.int64).reshape(-1, 2).T
            else:
                level, length = np.ones(len(n), np.int64), np.maximum(0, shared - needed(n, percent) + 1)
            prefix = np.minimum(length, shared)
            columns = [batch.column(k) for k in (0, 1, 2, 3, 4, 6)]
            out = pa.RecordBatch.from_arrays(
                [*columns, pa.array(level), pa.array(prefix)],
                ["set_id", "n", "copies", "doc_id", "part", "tokens", "asks", "prefix"],
            )
            yield out.filter(pa.array(prefix > 0))

    return lists.mapInArrow(
        run,
        "set_id long, n long, copies long, doc_id long, part long, tokens array<long>, asks long, prefix long",
    )


def joined_up(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked places one label, the smallest."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        np.minimum.at(label, np.maximum(x, y)[differ], np.minimum(x, y)[differ])
        while (label != label[label]).any():
            label[:] = label[label]


def contracted(edges: DataFrame) -> DataFrame:
    """Edges ``a, b`` as stars: within every 500,000 that a task reads, each node hangs on the smallest it reaches."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        both = [np.concatenate([batch.column(k).to_numpy() for batch in held]) for k in (0, 1)]
        nodes, at = np.unique(np.concatenate(both), return_inverse=True)
        label = np.arange(len(nodes))
        joined_up(label, at[: len(both[0])], at[len(both[0]) :])
        own = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[label[own]])], ["a", "b"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= EDGES_PER_FILE:
                yield stars(held)
                held, n = [], 0
        if held:
            yield stars(held)

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, root``: the smallest node that each node of ``a, b`` is connected with.

    Tasks contract the edges that they read; what is still open goes through rounds of a large and a small star, and
    what fits one file is finished by one more contraction. Each round is a written table, and only two counts reach
    the driver.
    """
    sides = lambda e: e.union(e.select(F.col("b"), F.col("a")))

    def star(edges, large):
        both = sides(edges).toDF("u", "v")
        if not large:
            both = both.where("v < u")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = both.join(least, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
        return out.where("a != b").distinct()

    current = written(contracted(edges.where("a != b")), label)
    while True:
        ends = current.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
            current.select("b", F.lit(0), F.lit(1))
        )
        nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        told = nodes.agg(F.sum("up").alias("edges"), F.count_if(F.expr("up > 1 OR (up = 1 AND down = 1)")).alias("open")).first()
        if not told["open"]:  # every node hangs on one root, and no root hangs on another
            break
        parts = told["edges"] // EDGES_PER_FILE + 1
        left = current if parts == 1 else star(star(current, True), False)
        current = written(contracted(left.coalesce(parts)), label)
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select("b", "b").distinct()
    )


def _links(a: dict, b: dict | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked sets in ``a`` and in ``b``, or of those within ``a``, each once."""
    other = a if b is None else b
    prefix_of = np.concatenate([np.arange(x) for x in other["prefix"]])
    owner = np.repeat(np.arange(len(other["n"])), other["prefix"])
    listed = other["tokens"][np.repeat(other["first"], other["prefix"]) + prefix_of]
    order = np.argsort(listed, kind="stable")
    listed, owner, prefix_of = listed[order], owner[order], prefix_of[order]
    every = np.argsort(other["tokens"], kind="stable")
    all_tokens, all_owner = other["tokens"][every], np.repeat(np.arange(len(other["n"])), other["size"])[every]
    m = len(other["n"])
    left, right = [], []

    def spread(lo, hi):
        count = hi - lo
        return np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))

    for i in range(len(a["n"])):
        mine = a["tokens"][a["first"][i] : a["first"][i] + a["size"][i]]
        probe = mine[: a["prefix"][i]]
        lo, hi = np.searchsorted(listed, probe, "left"), np.searchsorted(listed, probe, "right")
        at = spread(lo, hi)
        met = owner[at]
        matches = np.bincount(met, minlength=m)
        n, sizes = a["n"][i], other["n"]
        fits = (matches > 0) & (matches >= np.minimum(a["asks"][i], other["asks"]))
        fits &= (100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes))
        if b is None:
            fits[: i + 1] = False
        if not fits.any():
            continue
        # what can still be common behind the last common prefix token
        ours, theirs = np.zeros(m, np.int64), np.zeros(m, np.int64)
        np.maximum.at(ours, met, np.repeat(np.arange(len(probe)), hi - lo))
        np.maximum.at(theirs, met, prefix_of[at])
        rest = np.minimum(a["size"][i] - ours - 1, other["size"] - theirs - 1)
        fits &= (100 + percent) * (matches + rest) >= percent * (n + sizes)
        if not fits.any():
            continue
        lo, hi = np.searchsorted(all_tokens, mine, "left"), np.searchsorted(all_tokens, mine, "right")
        common = np.bincount(all_owner[spread(lo, hi)], minlength=m)
        found = np.flatnonzero(fits & (100 * common >= percent * (n + sizes - common)))
        left.append(np.full(len(found), i))
        right.append(found)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _block(table: pa.Table) -> dict:
    tokens = table.column("tokens").combine_chunks()
    size = np.diff(tokens.offsets.to_numpy())
    columns = {name: table.column(name).to_numpy() for name in ("set_id", "n", "copies", "asks", "prefix")}
    return columns | {
        "tokens": tokens.flatten().to_numpy(), "size": size, "first": np.cumsum(size) - size,
        "doc_id": table.column("doc_id").to_pylist(), "part": table.column("part").to_pylist(),
    }


OUT = {
    "set_id": pa.int64(), "n_links": pa.int64(), "doc_id": pa.int64(), "part": pa.int64(), "others": pa.list_(pa.int64()),
}


def links(sets: DataFrame, percent: int, label: str) -> DataFrame:
    """For each set with a partner: ``set_id, n_links`` items linked, ``doc_id, part`` of the first of them.

    A set has one row for each pair of blocks that it is linked in; the links to ``others`` span its component.
    """
    postings = sets.select("set_id", F.explode(F.expr("slice(tokens, 1, int(prefix))")).alias("token"))
    hubs = postings.groupBy("token").agg(F.min("set_id").alias("b"), F.count("*").alias("size")).where("size > 1")
    edges = postings.join(hubs, "token").select(F.col("set_id").alias("a"), "b")
    # all edges of a set in one task, which makes one of them; by token, each of the set's tokens would leave one
    family = components(edges.repartition("a"), f"{label}-families").withColumnRenamed("node", "set_id")
    held = sets.join(family, "set_id")
    running = Window.partitionBy("root").orderBy("set_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = sets.select("set_id", F.size("tokens").alias("size")).join(family, "set_id")
    placed = placed.select(
        "set_id", "root", F.floor(F.coalesce(F.sum("size").over(running), F.lit(0)) / BLOCK_TOKENS).alias("block")
    )
    blocks = placed.groupBy("root").agg(F.max("block").alias("last"))
    placed = placed.join(blocks, "root").select("set_id", "block", "last")
    held = held.join(placed, "set_id").withColumn("with", F.explode(F.expr("sequence(0L, last)")))
    # families of one block share a group with others, so that groups are not too small
    total = sets.agg(F.sum(F.size("tokens"))).first()[0] or 0
    packs = total // PACK_TOKENS + 1
    pack = F.when(F.col("last") > 0, F.concat(F.lit("r"), F.col("root"))).otherwise(
        F.concat(F.lit("p"), F.pmod(F.xxhash64("root"), F.lit(packs)))
    )
    held = held.select(
        pack.alias("pack"), F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block",
        "set_id", "n", "copies", "doc_id", "part", "tokens", "asks", "prefix",
    )

    def work(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        block = table.column("block").to_numpy()
        a = _block(table.filter(pa.array(block == low)))
        b = None if low == high else _block(table.filter(pa.array(block == high)))
        if not len(a["n"]) or b is not None and not len(b["n"]):
            return pa.table({k: pa.array([], t) for k, t in OUT.items()})
        left, right = _links(a, b, percent)
        other = b or a
        linked: dict[int, list] = {}
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def note(x, i, y, j, spans):
            row = linked.setdefault(int(x["set_id"][i]), [0, None, []])
            row[0] += int(y["copies"][j])
            at = (y["doc_id"][j] is None, y["doc_id"][j] or 0, y["part"][j])
            row[1] = at if row[1] is None else min(row[1], at)
            if spans:
                row[2].append(int(y["set_id"][j]))

        for i, j in zip(left.tolist(), right.tolist()):
            x, y = find(int(a["set_id"][i])), find(int(other["set_id"][j]))
            root[x] = y
            note(a, i, other, j, x != y)
            note(other, j, a, i, False)
        rows = list(linked.items())
        return pa.table(
            {
                "set_id": pa.array([k for k, _ in rows], pa.int64()),
                "n_links": pa.array([v[0] for _, v in rows], pa.int64()),
                "doc_id": pa.array([None if v[1][0] else v[1][1] for _, v in rows], pa.int64()),
                "part": pa.array([v[1][2] for _, v in rows], pa.int64()),
                "others": pa.array([v[2] for _, v in rows], pa.list_(pa.int64())),
            }
        )

    schema = "set_id long, n_links long, doc_id long, part long, others array<long>"
    return held.groupBy("pack", "low", "high").applyInArrow(work, schema)


def similar(
    rows: DataFrame, sets: Sets, percent: int, adaptive: bool, label: str, cut: Cut | None = None
) -> tuple[DataFrame, DataFrame]:
    """All items, and the links of their sets as ``links`` gives them; both as written tables."""
    all_items = written(items(rows, sets, percent), f"{label}-items")
    left = written(survivors(all_items, screened(all_items), percent), f"{label}-left")
    tokens = written(token_table(rows, sets, left, cut), f"{label}-tokens")
    ready = written(ordered(tokens, left, percent, adaptive), f"{label}-sets")
    return all_items, written(links(ready, percent, label), f"{label}-links")
