"""Near-duplicate documents: an inverted join of MinHash signature coordinates, confirmed on the full sets.

A document's set holds its distinct 2-word shingles (words between blanks and the controls 9 to 13, A to Z lower-cased); with fewer
words, the whole sequence; without words it is empty and linked with nothing. Documents with equal sets are one class, and
only one of each class, its representative, is compared. A signature has `COORDINATES` values; each is made of `DEPTH` minima, so that texts with little
in common, of which there are ever more, do not meet by chance. Two sets with a similarity of 0.8 agree in a coordinate with a
chance of 0.41, and in fewer than `MATCHES` of them in about one of a million cases.

Each representative is posted under its (coordinate, value) pairs. Pairs that only one has go, and so does a representative
with fewer than `MATCHES` left. In the order of rarity, two that agree in `MATCHES` pairs share one among the first
s - MATCHES + 1 of their s pairs, so only these prefixes are joined: what many documents have by chance is skipped. Of each two that
are joined the common coordinates are counted on their whole signatures, and only pairs with `MATCHES` or more come to their texts.

A list of a pair may still be long, as all near copies of a text share it. So lists are not joined with themselves. First, in
`ROUNDS` rounds, each representative is compared with `LEADS` others that lead its lists, and components of the links become labels. Then
what has not the most frequent label of its list is compared with all of that label, in blocks. Every pair above the threshold that is
left out has a common label, and so a path of confirmed links. Links are counted on the full sets of both texts.

`row_classes` tells rows apart by their place in a written copy of the table, so ids may be of any type, null or shared by several rows: each row has a class, named by its
least id (null if none of its rows has one), and repeated rows are copies of each other. `classes` is the same for a table whose ids are whole numbers that no two rows share. A null or
empty text, or one of blanks only, is linked with nothing. An empty table gives no rows. Texts of any length are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.components import components
from sluiceway.llm.stage import col, discard, written
from sluiceway.llm.text import Words, bounded_batches, lower_ascii, mixed, sequence_hashes, slices, space_words

SIMILARITY = 80
COORDINATES = 48
DEPTH = 4
MATCHES = 5
ROUNDS = 2
LEADS = 4
ASKING = 256
ASKED = 1024


def shingles(words: Words, size: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each distinct shingle, in order."""
    left = words.left()
    length = np.minimum(size, np.repeat(words.count, words.count))
    at = np.flatnonzero(left >= length)
    hashes = sequence_hashes(words.hashes(), at, length[at])
    owner = words.owner()[at]
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set size, two keys of the set and its signature (null without words)."""
    chars, fold = space_words(), lower_ascii()
    factors = mixed(np.arange(COORDINATES * DEPTH, dtype=np.uint64), 7) | np.uint64(1)
    masks = mixed(np.arange(COORDINATES * DEPTH, dtype=np.uint64), 8)
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(batch.column("text"), chars, fold)
            owner, hashes = shingles(words)
            size = np.bincount(owner, minlength=batch.num_rows)
            some = np.flatnonzero(size)
            first = np.concatenate([[0], np.cumsum(size[some])])[:-1]
            keys = []
            for seed in (2, 3):
                key = np.zeros(batch.num_rows, np.uint64)
                if len(some):
                    key[some] = np.add.reduceat(mixed(hashes, seed), first)
                keys.append(pa.array(key.view(np.int64)))
            signature = np.zeros((len(some), COORDINATES), np.uint64)
            for c in range(COORDINATES if len(some) else 0):
                value = np.full(len(some), c, np.uint64)
                for d in range(c * DEPTH, (c + 1) * DEPTH):
                    value = mixed(value ^ np.minimum.reduceat((hashes ^ masks[d]) * factors[d], first), 1)
                signature[:, c] = value
            at = np.zeros(batch.num_rows + 1, np.int32)
            np.cumsum(np.where(size > 0, COORDINATES, 0), out=at[1:])
            values = pa.ListArray.from_arrays(pa.array(at), pa.array(signature.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size.astype(np.int64)), *keys, values], names=["id", "n", "k1", "k2", "signature"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose texts' sets are as similar as asked for."""
    chars, fold = space_words(), lower_ascii()
    for whole in batches:
        for batch in slices(whole, "text_a"):
            keys, pairs, sizes = [], [], []
            for side in ("text_a", "text_b"):
                owner, hashes = shingles(Words(batch.column(side), chars, fold))
                keys.append(mixed(hashes ^ mixed(owner.astype(np.uint64), 5), 6))
                pairs.append(owner)
                sizes.append(np.bincount(owner, minlength=batch.num_rows))
            key, pair = np.concatenate(keys), np.concatenate(pairs)
            order = np.argsort(key, kind="stable")
            key, pair = key[order], pair[order]
            common = np.bincount(pair[1:][key[1:] == key[:-1]], minlength=batch.num_rows)
            linked = 100 * common >= SIMILARITY * (sizes[0] + sizes[1] - common)
            linked &= common > 0
            if linked.any():
                yield batch.select(["a", "b"]).filter(pa.array(linked))


def _matched(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """Of pairs `a`, `b` those with `MATCHES` or more coordinates in common. Values of different coordinates never agree, so common values are counted."""
    of_a = signatures.select(F.col("rep").alias("a"), F.col("signature").alias("signature_a"))
    of_b = signatures.select(F.col("rep").alias("b"), F.col("signature").alias("signature_b"))
    both = pairs.hint("merge").join(of_a, "a").hint("merge").join(of_b, "b")
    return both.where(F.size(F.array_intersect("signature_a", "signature_b")) >= MATCHES).select("a", "b")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs `a`, `b` those that are linked. Here as elsewhere the hint keeps one way of joining at every size."""
    texts_a = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    texts_b = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    return pairs.hint("merge").join(texts_a, "a").hint("merge").join(texts_b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_compared, "a long, b long")


def classes(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document that has an id: `id`, `n_shingles`, `component` (the smallest id reachable)."""
    bounded_batches(docs.sparkSession)
    known = docs.select(col(id_column).cast("long").alias("id"), col(text).cast("string").alias("text"))
    signed = written(known.where("id IS NOT NULL").mapInArrow(_signed, "id long, n long, k1 long, k2 long, signature array<long>"))
    groups = written(signed.where("n > 0").groupBy("k1", "k2").agg(F.min("id").alias("rep")))
    members = written(signed.join(groups.hint("merge"), ["k1", "k2"]).select("id", "rep", F.when(F.col("id") == F.col("rep"), F.col("signature")).alias("signature")))
    discard(groups)
    least = _linked(known, members)
    reached = members.select("id", "rep").join(least.select(F.col("node").alias("rep"), "least").hint("merge"), "rep", "left")
    reached = reached.groupBy("id").agg(F.min(F.coalesce("least", "rep")).alias("component"))
    sizes = signed.groupBy("id").agg(F.max("n").alias("n_shingles"))
    return sizes.join(reached, "id", "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component"))


def _linked(known: DataFrame, members: DataFrame) -> DataFrame:
    """Rows `node`, `least` for the representatives that are linked with another."""
    signatures = written(members.where("signature IS NOT NULL").dropDuplicates(["rep"]).select("rep", "signature"))
    posted = signatures.select("rep", F.explode("signature").alias("pair"))
    often = written(posted.groupBy("pair").agg(F.count("*").alias("n")).where("n > 1"))
    held = posted.join(often.hint("merge"), "pair").groupBy("rep").agg(F.collect_list(F.struct("n", "pair")).alias("pairs")).where(F.size("pairs") >= MATCHES)
    prefix = F.slice(F.sort_array("pairs"), 1, F.size("pairs") - MATCHES + 1)
    lists = written(held.select("rep", F.explode(prefix).alias("p")).select("rep", F.col("p.pair").alias("pair")))
    discard(often)
    wanted = written(lists.select("rep").distinct())
    every, signatures = signatures, written(signatures.hint("merge").join(wanted, "rep", "left_semi"))
    discard(every)
    # Texts of one id are as one: rows that share an id and differ would each be a class of their own.
    texts = written(known.join(wanted.hint("merge"), F.col("id") == F.col("rep"), "left_semi").select(F.col("id").alias("rep"), "text").dropDuplicates(["rep"]))
    links = None
    for turn in range(ROUNDS):
        entries = lists if links is None else lists.join(labels.hint("merge"), "rep", "left")
        label = F.col("rep") if links is None else F.coalesce("least", "rep")
        entries = entries.withColumn("label", label).select("pair", "rep", "label")
        found = written(_confirmed(_matched(_led(entries, turn), signatures), texts))
        links = found if links is None else links.union(found)
        labels = components(links).withColumnRenamed("node", "rep")
    entries = written(lists.join(labels.hint("merge"), "rep", "left").select("pair", "rep", F.coalesce("least", "rep").alias("label")))
    found = written(_left_over(entries, texts, signatures))
    discard(texts, signatures, lists, wanted, entries)
    return written(components(links.union(found)))


def _led(entries: DataFrame, turn: int) -> DataFrame:
    """For each representative at most LEADS others with another label, each the leader of one of its lists; leaders are drawn anew in each turn."""
    rank = F.xxhash64(F.lit(turn), "rep", "pair")
    lead = entries.groupBy("pair").agg(
        F.min_by("rep", rank).alias("lead"), F.min_by("label", rank).alias("lead_label"), F.min("label").alias("low"), F.max("label").alias("high"))
    lead = written(lead.where("low <> high").drop("low", "high"))
    pairs = entries.join(lead, "pair").where("label <> lead_label").groupBy("rep").agg(F.collect_set("lead").alias("leads"))
    ordered = F.transform(F.slice(F.sort_array(F.transform("leads", lambda x: F.struct(F.xxhash64(x, "rep").alias("r"), x.alias("x")))), 1, LEADS), lambda y: y["x"])
    return pairs.select(F.col("rep").alias("a"), F.explode(ordered).alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _left_over(entries: DataFrame, texts: DataFrame, signatures: DataFrame) -> DataFrame:
    """Links between different labels that share a list.

    The most frequent label of a list stands for it. All others of the list are asked: each is compared with every member of that label, and with all
    that are asked for it. Askers and those they ask are cut into blocks, and each pair of blocks is one unit of work with a bounded
    number of texts, of which only the links come out.
    """
    counts = entries.groupBy("pair", "label").agg(F.count("*").alias("n"))
    main = counts.groupBy("pair").agg(F.max_by("label", "n").alias("main"), F.count("*").alias("labels")).where("labels > 1").drop("labels")
    asking = entries.join(written(main), "pair").where("label <> main").select("main", "rep", "label").distinct()
    asking = written(asking)
    labels = entries.select("rep", "label").distinct()
    asked = labels.join(asking.select("main").distinct(), F.col("label") == F.col("main")).select("main", "rep", "label")
    both = asked.withColumn("asks", F.lit(False)).union(asking.withColumn("asks", F.lit(True)))
    blocks = written(both.groupBy("main").agg(
        F.ceil(F.sum(F.col("asks").cast("int")) / ASKING).cast("int").alias("rows"), F.ceil(F.count("*") / ASKED).cast("int").alias("columns")))
    both = both.join(blocks, "main").withColumns({"r": F.pmod(F.xxhash64("rep"), F.col("rows")), "c": F.pmod(F.xxhash64("rep", F.lit(1)), F.col("columns"))})
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    units = both.where("asks").select("main", F.col("r").cast("int").alias("r"), F.explode(every("columns")).alias("c"), "rep", "label", "asks").union(
        both.select("main", F.explode(every("rows")).alias("r"), F.col("c").cast("int").alias("c"), "rep", "label", F.lit(False)))
    units = units.select(F.xxhash64("main", "r", "c").alias("unit"), "rep", "label", "asks").hint("merge").join(signatures, "rep").hint("merge").join(texts, "rep")
    units = units.select("unit", "asks", "rep", "label", "signature", "text")
    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(_unit_links, "a long, b long")


def _unit_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each unit. Rows come in order of their units."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        rest.append(batch)
        unit = batch.column("unit").to_numpy()
        if rest[0].column("unit")[0].as_py() != unit[-1]:
            table = pa.Table.from_batches(rest).combine_chunks()
            unit = table.column("unit").to_numpy()
            changes = (np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist()
            for a, b in zip([0, *changes[:-1]], changes):
                yield from _linked_blocks(table.slice(a, b - a))
            rest = table.slice(changes[-1]).combine_chunks().to_batches()
    if rest:
        table = pa.Table.from_batches(rest).combine_chunks()
        unit = table.column("unit").to_numpy()
        changes = (np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist()
        for a, b in zip([0, *changes], [*changes, table.num_rows]):
            yield from _linked_blocks(table.slice(a, b - a))


def _enough_matches(signatures_a: np.ndarray, signatures_b: np.ndarray) -> np.ndarray:
    """For each of `b` and each of `a` whether `MATCHES` or more coordinates agree."""
    count = np.zeros((len(signatures_b), len(signatures_a)), np.uint8)
    for c in range(COORDINATES):
        count += signatures_b[:, c, None] == signatures_a[None, :, c]
    return count >= MATCHES


def _linked_blocks(unit: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links between the texts that ask and those that are asked, with different labels. Only texts that a pair above the threshold names are read."""
    asks = unit.column("asks").to_numpy()
    if asks.all() or not asks.any():
        return
    label = unit.column("label").to_numpy()
    signatures = unit.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
    enough = _enough_matches(signatures[asks], signatures[~asks]) & (label[~asks, None] != label[None, asks])
    chars, fold = space_words(), lower_ascii()
    sides = []
    for mask, named in ((asks, enough.any(0)), (~asks, enough.any(1))):
        if not named.any():
            return
        part = unit.select(["rep", "label", "text"]).take(pa.array(np.flatnonzero(mask)[named]))
        owner, hashes = shingles(Words(part.column("text").combine_chunks(), chars, fold))
        sides.append((part.column("rep").to_numpy(), np.bincount(owner, minlength=part.num_rows), owner, hashes))
    enough = enough[enough.any(1)][:, enough.any(0)]
    (rep_a, size_a, owner_a, hash_a), (rep_b, size_b, owner_b, hash_b) = sides
    order = np.argsort(hash_a, kind="stable")
    owner_a, hash_a = owner_a[order], hash_a[order]
    first = np.searchsorted(hash_a, hash_b)
    number = np.searchsorted(hash_a, hash_b, "right") - first
    total = np.concatenate([[0], np.cumsum(number)])
    n = len(rep_a)
    at = 0
    while at < len(rep_b):
        # As many of those asked as have about a million shingles in common with those that ask.
        begin = np.searchsorted(owner_b, at)
        last = owner_b[min(len(owner_b) - 1, max(begin, int(np.searchsorted(total, total[begin] + (1 << 20))) - 1))] if begin < len(owner_b) else len(rep_b) - 1
        to = max(at + 1, int(last))
        end = np.searchsorted(owner_b, to)
        count = number[begin:end]
        index = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[begin:end], count)
        common = np.bincount((np.repeat(owner_b[begin:end], count) - at) * n + owner_a[index], minlength=(to - at) * n).reshape(to - at, n)
        linked = 100 * common >= SIMILARITY * (size_b[at:to, None] + size_a[None, :] - common)
        linked &= (common > 0) & enough[at:to]
        b, a = np.nonzero(linked)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(rep_a[a]), pa.array(rep_b[at + b])], names=["a", "b"])
        at = to


def row_classes(docs: DataFrame, carry: Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row: `row`, `id`, `n_shingles`, `component` (the least id of the class) and `first` (whether it is the class's first row by id)."""
    place = F.monotonically_increasing_id().alias("place")
    rows = written(docs.select(place, carry.alias("row"), col(id_column).alias("id"), col(text).cast("string").alias("text")))
    found = written(classes(rows.select("place", "text"), "place").select(F.col("id").alias("place"), "n_shingles", "component"))
    slim = rows.select("place", "row", "id").join(found.hint("shuffle_hash"), "place")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "place")
    # Written, so that both sides of the join come straight from a shuffle: only then does Spark split the partition of a class with very many rows.
    least = written(slim.groupBy("component").agg(F.min(order).alias("least")))
    return slim.join(least.hint("shuffle_hash"), "component").select(
        "row", "id", "n_shingles", F.col("least.id").alias("component"), (F.col("least.place") == F.col("place")).alias("first"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that of the least id; columns as they were. Copies without an id and repeated rows go as others do."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    place = F.monotonically_increasing_id().alias("place")
    rows = written(docs.select(place, F.struct(*[col(c).alias(n) for c, n in zip(docs.columns, names)]).alias("row")))
    at = lambda column: F.col("row")[names[docs.columns.index(column)]]
    found = written(classes(rows.select("place", at(text).alias("text")), "place").select(F.col("id").alias("place"), "component"))
    slim = rows.select("place", at(id_column).alias("id")).join(found.hint("shuffle_hash"), "place")
    kept = slim.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "place")).alias("least")).select(F.col("least.place").alias("place"))
    return rows.join(kept.hint("shuffle_hash"), "place", "left_semi").select(*[F.col("row")[n].alias(c) for c, n in zip(docs.columns, names)])
