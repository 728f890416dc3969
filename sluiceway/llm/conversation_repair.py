"""Conversation repair: the cheapest edits that give a legal order of roles, by dynamic programming with checkpoints.

Turns stand in the order of `turn` (null first; equal ones by role and text). Legal are an optional system turn and then pairs of user and assistant, told by the
initials of their roles, or nothing at all. Keeping a turn costs 0, giving it the role user or assistant 1, deleting it 2, inserting an empty turn of the
user or assistant 5. Blank turns, and those whose role and text occurred before, must go; a turn that is kept although its text breaks off costs 5 more.
Of the cheapest edits those are taken whose initials (D, I, K, R) come first as text.

A conversation of n turns is cut into blocks, the k-th of which has `BLOCK` * (2k + 1) turns, so both their number and their length grow with the square root of n. For each block the
cost from every state (none, system, user, assistant) at its start to every state at its end is found; backward over the blocks this gives the vector of
costs that remain at each block's end, and only these checkpoints are kept. Each block then computes its own vectors again from its checkpoint and walks forward by edits
on which no cost is lost, the least initial first, from every state in which it may begin. So a conversation that holds a third of all turns is spread over many tasks, each
of which sees one block, and what comes together for one conversation is a few numbers a block. Only the digest of the repaired text runs over a conversation in one pass;
it streams blocks and keeps nothing but its state.

Defined cases: null values count as one space, so a null text is blank and a null role is no role; a null conversation id is a conversation of its own;
repeated rows are duplicates; a conversation without rows is not reported, and no rows give no result; texts of any length are carried whole; other columns, of any name, take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.numbering import in_order
from sluiceway.llm.stage import col, written
from sluiceway.llm.text import bounded_batches

BLOCK = 64
REROLE, DELETE, INSERT, BROKEN_OFF = 1, 2, 5, 5
_WORD = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"
_FAR = 1 << 40
# States: nothing yet, after the system turn, after a user's, after an assistant's. The turn that comes next is a user's, or after a user's an assistant's.
_SYSTEM, _USER = 1, 2
_NEXT = np.array([2, 2, 3, 2])
_AFTER_NEXT = _NEXT[_NEXT]
_END = np.array([0, 2 * INSERT, INSERT, 0])
_TAIL = ("", "II", "I", "")
#: Codes of turns: d must go; s, u, a and x by role, in capitals if the text breaks off.
_CODES = "dsuaxSUAX"
_D, _I, _K, _R = (ord(x) for x in "DIKR")


def _costs() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code and state: what going on to the next state costs, what keeping costs, the state that it leads to, and what keeping a system turn at the start costs."""
    go, keep, system = (np.full((len(_CODES), 4), _FAR) for _ in range(3))
    to = np.tile(_NEXT, (len(_CODES), 1))
    for c, code in enumerate(_CODES[1:], 1):
        extra = BROKEN_OFF if code.isupper() else 0
        for state in range(4):
            fits = code.lower() == ("a" if state == _USER else "u")
            go[c, state] = extra + (0 if fits else REROLE)
            if fits:
                keep[c, state] = extra
        if code.lower() == "s":
            keep[c, 0] = system[c, 0] = extra
            to[c, 0] = _SYSTEM
    return go, keep, to, system


_GO, _KEEP, _TO, _KEEP_SYSTEM = _costs()


def _before(after: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Costs by block and state (and end state) before a turn, from those after it; up to two turns may be inserted before it."""
    more = (slice(None), slice(None), *[None] * (after.ndim - 2))
    best = np.minimum(after + DELETE, _GO[code][more] + after[:, _NEXT])
    best = np.minimum(best, _KEEP_SYSTEM[code][more] + after[:, [_SYSTEM]])
    return np.minimum(np.minimum(best, INSERT + best[:, _NEXT]), 2 * INSERT + best[:, _AFTER_NEXT])


def _chunks(codes: list[str], room: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of similar length together: their places, code numbers (a row each) and lengths, of bounded size unless one block is longer."""
    length = np.array([len(c) for c in codes], np.int64)
    order = np.argsort(-length, kind="stable")
    number = np.zeros(128, np.int64)
    number[[ord(c) for c in _CODES]] = np.arange(len(_CODES))
    at = 0
    while at < len(order):
        mine = order[at : at + max(1, room // max(1, int(length[order[at]])))]
        table = np.zeros((len(mine), int(length[mine[0]])), np.int64)
        for row, i in enumerate(mine):
            table[row, : length[i]] = number[np.frombuffer(codes[i].encode(), np.uint8)]
        yield mine, table, length[mine]
        at += len(mine)


def block_costs(codes: list[str]) -> np.ndarray:
    """For each block the costs from each state at its start to each at its end."""
    out = np.zeros((len(codes), 4, 4), np.int64)
    for mine, table, length in _chunks(codes):
        costs = np.tile(np.where(np.eye(4, dtype=bool), 0, _FAR), (len(mine), 1, 1))
        for i in range(table.shape[1] - 1, -1, -1):
            n = int((length > i).sum())  # the longest come first
            costs[:n] = np.minimum(_before(costs[:n], table[:n, i]), _FAR)
        out[mine] = costs
    return out


def walks(codes: list[str], after: np.ndarray, last: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
    """The edits of each block from each state at its start, and the states at its end; `after` has the costs that remain there."""
    edits: list[list[str]] = [[""] * 4 for _ in codes]
    ends = np.zeros((len(codes), 4), np.int64)
    for mine, table, length in _chunks(codes):
        n, longest = table.shape
        costs = np.zeros((longest + 1, n, 4), np.int64)
        costs[length, np.arange(n)] = after[mine]
        for i in range(longest - 1, -1, -1):
            active = int((length > i).sum())
            costs[i, :active] = _before(costs[i + 1, :active], table[:active, i])
        block, state = np.repeat(np.arange(n), 4), np.tile(np.arange(4), n)
        place, letters = np.zeros(4 * n, np.int64), []
        going = np.flatnonzero(place < length[block])
        while len(going):
            b, s, i = block[going], state[going], place[going]
            code, now = table[b, i], costs[i, b, s]
            later = costs[i + 1, b]
            row, onward = np.arange(len(b)), _NEXT[s]
            delete = DELETE + later[row, s] == now
            insert = INSERT + costs[i, b, onward] == now
            to = _TO[code, s]
            keep = _KEEP[code, s] + later[row, to] == now
            letter = np.where(delete, _D, np.where(insert, _I, np.where(keep, _K, _R)))
            state[going] = np.where(delete, s, np.where(~insert & keep, to, onward))
            place[going] += letter != _I
            written_now = np.zeros(4 * n, np.uint8)
            written_now[going] = letter
            letters.append(written_now)
            going = going[place[going] < length[b]]
        texts = [x.tobytes().replace(b"\0", b"").decode() for x in np.stack(letters, 1)] if letters else [""] * (4 * n)
        for w, text in enumerate(texts):
            i = int(mine[block[w]])
            edits[i][w % 4] = text + (_TAIL[state[w]] if last[i] else "")
        ends[mine] = state.reshape(n, 4)
    return edits, ends


# Over Arrow batches

def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds `at`, the order of the turns, and `block`, the `at` of the first turn of a turn's block. Turns come in order."""
    at, first, current = TaskContext.get().partitionId() << 33, 0, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column("conv")
        new = np.ones(n, bool)
        new[1:] = pc.not_equal(conv[1:], conv[:-1]).to_numpy(zero_copy_only=False)
        new[0] = conv[0].as_py() != current
        places = at + np.arange(n)
        starts = np.maximum.accumulate(np.where(new, places, 0))
        starts[starts == 0] = first
        k = np.floor(np.sqrt((places - starts) / BLOCK)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places), pa.array(starts + BLOCK * k * k)], names=[*batch.schema.names, "at", "block"])
        at, first, current = at + n, int(starts[-1]), conv[n - 1].as_py()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = block_costs(batch.column("codes").to_pylist())
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(costs) + 1, dtype=np.int32) * 16), pa.array(costs.ravel()))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv", "block", "opens", "closes", "illegal")], flat], names=["conv", "block", "opens", "closes", "illegal", "costs"])


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the blocks of each conversation: what remains after each block; and, with the first, the whole cost and the illegal neighbours."""
    for batch in batches:
        rows = []
        for conv, blocks in zip(batch.column("conv").to_pylist(), batch.column("blocks").to_pylist()):
            after, illegal, mine = _END, 0, []
            for j in range(len(blocks) - 1, -1, -1):
                b = blocks[j]
                mine.append([conv, b["block"], after.tolist(), j == len(blocks) - 1, j == 0, None, None])
                after = (np.array(b["costs"]).reshape(4, 4) + after).min(1)
                illegal += b["illegal"] + (j > 0 and blocks[j - 1]["closes"] + b["opens"] not in ("su", "ua", "au"))
            mine[-1][5:] = [int(after[0]), illegal]
            rows += mine
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
        names = ["conv", "block", "after", "last", "first", "cost", "illegal"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        edits, ends = walks(batch.column("codes").to_pylist(), np.array(batch.column("after").to_pylist(), np.int64), batch.column("last").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("block"), pa.array(edits, pa.list_(pa.string())), pa.array(ends.tolist(), pa.list_(pa.int64()))], names=["conv", "block", "edits", "ends"])


def _begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each block of a conversation begins."""
    for batch in batches:
        names, states = [], []
        for blocks in batch.column("blocks").to_pylist():
            state = 0
            for b in blocks:
                names.append(b["block"])
                states.append(state)
                state = b["ends"][state]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(states, pa.int32())], names=["block", "state"])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns of each block after its edits."""
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for batch in batches:
        out = []
        for turns, edits, state in zip(*[batch.column(c).to_pylist() for c in ("turns", "edits", "state")]):
            lines, left = [], iter(turns)
            for edit in edits:
                role, text = "assistant" if state == _USER else "user", ""
                if edit != "I":
                    turn = next(left)
                    if edit == "D":
                        continue
                    text = turn["text"]
                    if edit == "K":
                        role = turn["role"]
                lines.append({"role": role, "text": text})
                state = _SYSTEM if edit == "K" and state == 0 and role[:1] == "s" else int(_NEXT[state])
            out.append(lines)
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv", "block", "edits")], pa.array(out, kind)], names=["conv", "block", "edits", "lines"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits and digest of each conversation, whose blocks come in order."""
    current, edits, digest, begun = None, [], None, False

    def done(rows):
        columns = [pa.array([r[i] for r in rows], pa.string()) for i in range(3)]
        return pa.RecordBatch.from_arrays(columns, names=["conv", "audit", "sha"])

    for batch in batches:
        rows = []
        for conv, part, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "edits", "text")]):
            if conv != current:
                if current is not None:
                    rows.append((current, "".join(edits), digest.hexdigest()))
                current, edits, digest, begun = conv, [], hashlib.sha256(), False
            edits.append(part)
            if text is not None:
                digest.update((b"\n" if begun else b"") + text.encode())
                begun = True
        yield done(rows)
    if current is not None:
        yield done([(current, "".join(edits), digest.hexdigest())])


# The steps

class Repair(NamedTuple):
    """`turns`: the repaired conversations (`conv_id`, `place`, `role`, `text`); `report`: one row for each conversation that has turns."""

    turns: DataFrame
    report: DataFrame


def _key(conv: Column) -> Column:
    """A conversation's id as text, also where it is null."""
    return F.coalesce(F.concat(F.lit("1"), conv.cast("string")), F.lit("0"))


def repair(frame: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The report has `conv_id`, `gaps`, `blank`, `duplicate`, `truncated`, `illegal`, `cost`, `audit` and `repaired_sha256`."""
    bounded_batches(frame.sparkSession)
    shown = lambda name: F.coalesce(col(name).cast("string"), F.lit(" "))
    turns = frame.select(_key(col(conv_id)).alias("conv"), col(conv_id).alias("id"), col(turn).cast("long").alias("turn"), shown(role).alias("role"), shown(text).alias("text"))
    plain = turns.select("conv", "turn", "role", "text")
    ordered = in_order(plain, ["conv", "turn", "role", "text"]).drop("_at")
    rows = written(ordered.mapInArrow(_cut, "conv string, turn long, role string, text string, at long, block long"))

    same = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text").cast("binary"), 256).alias("same")
    marked = written(rows.select(
        "conv", "turn", "at", "block", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(_WORD)).alias("blank"),
        (~F.col("text").rlike(_ENDED)).alias("broken"), same))
    first = marked.where("NOT blank").groupBy("conv", "same").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    flagged = marked.drop("same").join(first, "at", "left").withColumn("repeated", ~F.col("blank") & F.col("first").isNull())
    by_role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    code = F.when(F.col("blank") | F.col("repeated"), "d").when(F.col("broken"), F.upper(by_role)).otherwise(by_role)
    flagged = flagged.withColumn("code", code)
    blocks = flagged.groupBy("conv", "block").agg(
        F.sort_array(F.collect_list(F.struct("at", "code", "initial"))).alias("turns"), F.count_if("blank").alias("blank"), F.count_if("repeated").alias("duplicate"),
        F.count_if(F.col("broken") & ~F.col("blank") & ~F.col("repeated")).alias("truncated"))
    initials = F.col("turns.initial")
    pairs = F.zip_with(F.slice(initials, F.lit(1), F.size(initials) - 1), F.slice(initials, F.lit(2), F.size(initials)), lambda a, b: F.concat(a, b))
    blocks = written(blocks.select(
        "conv", "block", "blank", "duplicate", "truncated", F.array_join("turns.code", "").alias("codes"), initials[0].alias("opens"), F.element_at(initials, -1).alias("closes"),
        F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au"))).cast("long").alias("illegal")))

    listed = lambda table, *columns: table.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", *columns))).alias("blocks"))
    summed = blocks.mapInArrow(_summed, "conv string, block long, opens string, closes string, illegal long, costs array<long>")
    checked = written(listed(summed, "costs", "opens", "closes", "illegal").mapInArrow(
        _checked, "conv string, block long, after array<long>, last boolean, first boolean, cost long, illegal long"))
    walked = written(blocks.select("conv", "block", "codes").join(checked.select("block", "after", "last"), "block").mapInArrow(
        _walked, "conv string, block long, edits array<string>, ends array<long>"))
    begun = listed(walked, "ends").mapInArrow(_begun, "block long, state int")
    chosen = walked.join(begun, "block").select("conv", "block", F.get("edits", F.col("state")).alias("edits"), "state")

    texts = rows.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("turns"))
    edited = written(texts.join(chosen, "block").mapInArrow(_edited, "conv string, block long, edits string, lines array<struct<role:string,text:string>>"))
    lines = F.array_join(F.transform("lines", lambda x: F.concat_ws(":", x["role"], x["text"])), "\n")
    pieces = edited.select("conv", "block", "edits", F.when(F.size("lines") > 0, lines).alias("text"))
    digests = pieces.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(_digested, "conv string, audit string, sha string")

    names = turns.groupBy("conv").agg(F.first("id").alias("id"))
    span = marked.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    faults = blocks.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    costs = checked.where("first").select("conv", "cost", "illegal")
    report = names.join(span, "conv").join(faults, "conv").join(costs, "conv").join(digests, "conv").select(
        F.col("id").alias("conv_id"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.col("sha").alias("repaired_sha256"))
    spread = edited.join(names, "conv").select(F.col("id").alias("conv_id"), "block", F.posexplode("lines").alias("line", "x"))
    return Repair(spread.select("conv_id", F.struct("block", "line").alias("place"), "x.role", "x.text"), report)


def damaged(frame: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with faults, told by a hash of id and turn modulo 20: 0 drops a turn, 1 empties its text, 2 takes its ends of sentences, 3 repeats it, 4 makes it the user's."""
    shown = lambda name: F.coalesce(col(name).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat_ws(":", shown(conv_id), shown(turn)).cast("binary")), F.lit(20))
    rows = frame.select(col(conv_id).alias("conv_id"), col(turn).alias("turn"), shown(role).alias("role"), shown(text).alias("text"), fault.alias("fault"))
    changed = rows.where("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"), "fault")
    return changed.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))).drop("fault", "copy")
