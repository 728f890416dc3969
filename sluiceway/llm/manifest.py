"""Merkle manifest: a digest of every document, one of every language, one of the data set, and a proof of each document.

Digests are lower-case hex sha256 over text; those of nodes are over the digests below, written one after the other. Documents of a language
ascend by id (null first, equal ids by their leaf). As long as a group has several nodes, every `FAN` neighbours become one, the last run
has fewer and may have one. The root of each language is a node of the last tree, languages in the order of their bytes, null first.

The nodes of a tree are cut into aligned blocks of `FAN ** BLOCK_LEVELS`. A block keeps a level as one string of hex digits: parents are the
hashes of substrings of fixed width, and the siblings of a node are the substrings before and after it in its run. The roots of all blocks of a
group are the nodes of the next layer, which is cut in the same way, until each group has one root. Paths go down in turn, from a layer to the one below, so a
document's path is put together only where its block is at hand, and is never stored.

Defined cases: a null value counts as `-`, a null language as a language of its own; rows that are repeated are leaves of their own with equal digests; a table without
rows has no root and gives no rows; a text of any length is hashed where it is read and never moved; other columns, of any name, take no part. A row without an
id cannot be chosen for tampering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.numbering import numbered
from sluiceway.llm.stage import col, written

FAN = 8
BLOCK_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64
_RUN = FAN * _HEX
_BLOCK = FAN**BLOCK_LEVELS
_NO_PATH = "CAST(array() AS array<struct<l:binary,r:binary>>)"


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its number of bytes, a colon and itself, `-` if it is null."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(v) for v in values]).cast("binary"), 256)


def _blocks(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """One row for a block: its level strings `l0` to `l2`, how many levels it climbs, its `root` and the `payload` of its nodes in order.

    A block of a group with several blocks climbs all levels; one that is alone climbs until one node is left.
    """
    size = nodes.groupBy("group").agg((F.max("rank") + 1).alias("size"))
    block = F.floor(F.col("rank") / _BLOCK).alias("block")
    rows = nodes.select("group", block, F.struct("rank", "node", *payload).alias("node"))
    grouped = rows.groupBy("group", "block").agg(F.sort_array(F.collect_list("node")).alias("members")).join(size, "group")
    climbs = sum((F.col("size") > FAN**k).cast("int") for k in range(BLOCK_LEVELS))
    levels = grouped.select(
        "group", "block", climbs.alias("climbs"), F.array_join(F.col("members.node"), "").cast("binary").alias("l0"),
        F.transform("members", lambda m: F.struct(*[m[p].alias(p) for p in ("rank", *payload)])).alias("members"),
    )
    for k in range(BLOCK_LEVELS):
        levels = levels.withColumn(f"l{k + 1}", F.when(F.col("climbs") > k, _parents(f"l{k}")).otherwise(F.col(f"l{k}")))
    return levels.withColumn("root", F.col(f"l{BLOCK_LEVELS}").cast("string")).drop(f"l{BLOCK_LEVELS}")


def _parents(level: str) -> Column:
    """The level above: the hash of each run of a level's digests."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / _RUN).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * _RUN + 1, F.lit(_RUN)), 256)), "").cast("binary")


def _layers(nodes: DataFrame, *payload: str) -> list[DataFrame]:
    """Blocks of the nodes, of their roots, and so on until each group has one block. Few: their number is a logarithm of the largest group."""
    layers = []
    while True:
        blocks = written(_blocks(nodes, payload))
        layers.append(blocks)
        if blocks.where("block > 0").isEmpty():
            return layers
        nodes, payload = blocks.select("group", F.col("block").alias("rank"), F.col("root").alias("node")), ()


def _within(i: Column) -> Column:
    """The siblings of node `i` of a block on each level that the block climbs: those before and those after it in its run."""
    def flanks(k: int) -> Column:
        at = F.shiftright(i, 3 * k) if k else i
        run, inside = F.floor(at / FAN).cast("int") * _RUN, F.pmod(at, F.lit(FAN)) * _HEX
        return F.struct(
            F.substring(f"l{k}", run + 1, inside).alias("l"),
            F.substring(f"l{k}", run + inside + _HEX + 1, F.lit(_RUN - _HEX) - inside).alias("r"),
        )

    return F.slice(F.array(*[flanks(k) for k in range(BLOCK_LEVELS)]), F.lit(1), F.col("climbs"))


def _paths(layers: list[DataFrame], above: DataFrame, *payload: str) -> DataFrame:
    """Rows of the lowest layer's blocks with `up`, the path of the block's root, and what else `above` has for the group.

    `above` has `group`, `up` and other columns for the root of each group.
    """
    rest = [c for c in above.columns if c not in ("group", "up")]
    down = above.withColumn("block", F.lit(0).cast("long"))
    for layer in reversed(layers[1:]):
        blocks = layer.join(down, ["group", "block"])
        step = F.transform("members", lambda m, i: F.struct(m["rank"].alias("block"), F.concat(_within(i), F.col("up")).alias("up")))
        down = blocks.select("group", *rest, F.inline(step))
    return layers[0].join(down, ["group", "block"])


def manifest(docs: DataFrame, tampered: Column | None = None, tampered_leaf: Column | None = None, fields: Sequence[str] = FIELDS) -> DataFrame:
    """Rows `id`, `leaf`, `subroot`, `root`, `proof_sha256` and `folded_root`.

    `folded_root` comes from the document's leaf and its siblings; where `tampered` holds, from `tampered_leaf` instead.
    """
    own = leaf([col(f) for f in fields])
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered, tampered_leaf)
    # A null language comes before all others, which keep the order of their bytes.
    group = F.coalesce(F.concat(F.lit("1"), col(fields[2]).cast("string")), F.lit("0"))
    rows = docs.select(group.alias("group"), col(fields[0]).alias("id"), own.alias("node"), other.alias("other"))
    # Written first, as sorting samples its input before it reads it and would hash every text twice.
    layers = _layers(numbered(written(rows), "group", ["id", "node"]), "id", "other")
    subroots = layers[-1].select(F.lit("").alias("group"), F.col("group").alias("name"), F.col("root").alias("node"))
    top = _layers(numbered(subroots, "group", ["name"]), "name")
    roots = top[-1].select("group", F.expr(_NO_PATH).alias("up"), F.col("root").alias("whole"))
    named = F.transform("members", lambda m, i: F.struct(
        m["name"].alias("group"), F.substring("l0", i * _HEX + 1, F.lit(_HEX)).cast("string").alias("subroot"), F.concat(_within(i), F.col("up")).alias("up")))
    languages = written(_paths(top, roots).select("whole", F.inline(named)))
    blocks = _paths(layers, languages)

    def proved(m: Column, i: Column) -> Column:
        node = F.substring("l0", i * _HEX + 1, F.lit(_HEX)).cast("string")
        path = F.concat(_within(i), F.col("up"))
        return F.struct(m["id"].alias("id"), node.alias("leaf"), F.coalesce(m["other"], node).alias("start"), path.alias("path"))

    spread = blocks.select("subroot", F.col("whole").alias("root"), F.inline(F.transform("members", proved)))
    folded = F.aggregate("path", F.col("start"), lambda h, s: F.sha2(F.concat(s["l"], h.cast("binary"), s["r"]), 256))
    siblings = F.transform("path", lambda s: F.concat(s["l"], s["r"]).cast("string"))
    return spread.select(
        "id", "leaf", "subroot", "root", F.sha2(F.array_join(siblings, "").cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"))
