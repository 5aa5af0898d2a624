"""Repair of the turn structure of conversations, by cheapest edits.

Turns are brought into order by one range sort over (conversation, turn), so that a conversation of any length is spread
over as many tasks as its share of the rows asks for. Each run of a conversation within a partition is cut into blocks.
A conversation that is one block is solved at once. Of the others, a block is first summed up by the costs of leading
each state through it; these are chained backwards, which gives the cost vector at each block's end, a checkpoint; then
all blocks are walked at the same time, from each of the four states, and chained forwards. Only block summaries of a
conversation meet in a task, and for its digest, which is sequential by nature, its repaired text as a stream.

Rules: null role or text is one space; a null conversation is one of its own; null turns come first, and do not count
for gaps; turns of one number are ordered by role and text (their first 32 characters, then a digest); a role whose
initial is not s, u or a (the empty one too) must be changed or deleted. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from salestide.llm import edit_path
from salestide.session import materialize

# A block ends at the first of these.
BLOCK_TURNS, BLOCK_BYTES = 1 << 14, 1 << 20
BLANK = " \t\n\x0b\x0c\r"
MISSING = " "

# Kinds of rows in the sort: the mark of a conversation whose turn was dropped, the mark of a repeated turn, a turn.
_DROPPED, _REPEATED, _TURN = 0, 1, 2
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with a stated fault in some rows, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row (``dropped`` is true, so that its conversation is still known), 1 empties the text, 2 removes
    ``.!?`` from it, 3 repeats the row, 4 sets the role user.
    """
    written = [F.coalesce(F.col(name).cast("string"), F.lit(MISSING)) for name in ("conv_id", "turn")]
    fault = F.crc32(F.concat(written[0], F.lit(":"), written[1]).cast("binary")) % 20
    role, text = (F.coalesce(F.col(name), F.lit(MISSING)) for name in ("role", "text"))
    return rows.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _code(role: Column, text: Column) -> Column:
    initial = F.substring(role, 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    shown = F.rtrim(text, F.lit(BLANK))
    end = F.when(shown == "", edit_path.MUST_GO).when(F.right(shown, F.lit(1)).isin(".", "!", "?"), 0).otherwise(edit_path.CUT)
    return (number + end).cast("int")


def _in_order(rows: DataFrame) -> DataFrame:
    """Turns with codes, and marks of dropped rows and repeated turns right before them, sorted and spread by range."""
    told = F.concat_ws("\0", "role", "text")
    line = [F.when(~F.col("dropped"), F.col(name)).alias(name) for name in ("role", "text")]
    stored = materialize(
        rows.select(
            "conv_id", "turn", *line, _code(F.col("role"), F.col("text")).alias("code"),
            F.left(told, F.lit(32)).alias("tie"),
            F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), told).cast("binary"), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
            F.when(F.col("dropped"), _DROPPED).otherwise(_TURN).alias("kind"),
        ),
        "turns",
    )
    keys = ["conv_id", "turn", "tie", "digest", "row"]
    told_turns = stored.filter(F.col("kind") == _TURN).select(*keys)
    # The first of equal turns; the others are found by their row numbers, so that no number of copies meets in a task.
    firsts = told_turns.groupBy("conv_id", "digest").agg(F.min(F.struct("turn", "row"))["row"].alias("row"))
    repeats = told_turns.join(firsts.select("row"), "row", "left_anti").select(*keys).withColumn("kind", F.lit(_REPEATED))
    marked = stored.unionByName(repeats, allowMissingColumns=True)
    return marked.repartitionByRange(*keys).sortWithinPartitions(*keys, "kind").select("conv_id", "turn", "kind", "role", "text", "code")


_LINES = "array<struct<role:string,text:string>>"
_STATS = "turns bigint, first_turn {turn}, last_turn {turn}, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_code int, last_code int"


class _Block:
    """A run of one conversation's turns while it is read."""

    def __init__(self, conversation: object, number: int) -> None:
        self.conversation, self.number = conversation, number
        self.codes, self.lines, self.bytes = bytearray(), [], 0
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first_turn = self.last_turn = self.first_code = self.last_code = None

    def add(self, turn: object, role: str, text: str, code: int, repeated: bool) -> None:
        initial = code & 3
        if code & edit_path.MUST_GO:
            self.blank += 1
        elif repeated:
            self.duplicate += 1
            code = initial | edit_path.MUST_GO
        elif code & edit_path.CUT:
            self.truncated += 1
        if self.last_code is None:
            self.first_code = initial
        elif (self.last_code, initial) not in _LEGAL:
            self.illegal += 1
        self.last_code = initial
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        self.codes.append(code)
        self.lines.append((None, None) if code & edit_path.MUST_GO else (role, text))
        self.bytes += len(text) + 64

    def row(self, part: int, whole: bool) -> dict:
        codes = bytes(self.codes)
        found = {
            "conv_id": self.conversation, "part": part, "number": self.number, "whole": whole, "codes": codes,
            "lines": [{"role": role, "text": text} for role, text in self.lines],
        } | {name: getattr(self, name) for name in (
            "turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "first_code", "last_code",
        )}
        if whole:
            edits, state, cost = edit_path.walk(codes, edit_path.START, edit_path.END)
            edits += edit_path.closing(state)
            kept = edit_path.apply(edits, ((c, *line) for c, line in zip(codes, self.lines)), edit_path.START)
            return found | {"edits": edits, "cost": int(cost), "lines": [{"role": r, "text": t} for r, t in kept]}
        return found | {"matrix": edit_path.cross(codes)}


def _blocks(schema: pa.Schema, block_turns: int, block_bytes: int):
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        open_block, alone, repeated = None, False, False
        ready: list[dict] = []
        size = 0

        def close(last: bool) -> None:
            nonlocal size
            ready.append(open_block.row(part, alone and not last))
            size += open_block.bytes

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for conversation, turn, kind, role, text, code in zip(*columns):
                if open_block is None or conversation != open_block.conversation:
                    if open_block is not None:
                        close(False)
                        number += 1
                    # The first conversation of a partition may have begun in the one before.
                    alone = open_block is not None
                    open_block = _Block(conversation, number)
                elif len(open_block.codes) >= block_turns or open_block.bytes >= block_bytes:
                    alone = False
                    close(False)
                    number += 1
                    open_block = _Block(conversation, number)
                if kind == _REPEATED:
                    repeated = True
                elif kind == _TURN:
                    open_block.add(turn, role, text, code, repeated)
                    repeated = False
                if len(ready) >= 4096 or size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_pylist(ready, schema)
                    ready.clear()
                    size = 0
        if open_block is not None:
            close(True)
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)

    return cut


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    ready: list[dict] = []
    size = 0
    for row in rows:
        ready.append(row)
        size += 64 + sum(len(v) for v in row.values() if isinstance(v, (str, bytes)))
        size += sum(len(line["text"] or "") for line in row.get("lines") or ())
        if len(ready) >= 4096 or size >= BLOCK_BYTES:
            yield pa.RecordBatch.from_pylist(ready, schema)
            ready, size = [], 0
    if ready:
        yield pa.RecordBatch.from_pylist(ready, schema)


def _mapped(df: DataFrame, function, ddl: str) -> DataFrame:
    """``function`` from rows to rows over each partition of ``df``."""
    wanted = T.StructType.fromDDL(ddl)
    schema = to_arrow_schema(wanted)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(function(_rows(batches)), schema)

    return df.mapInArrow(run, wanted)


def _together(df: DataFrame, *order: Column | str) -> DataFrame:
    """Summaries of each conversation in one task, in order."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _ends(rows: Iterable[dict]) -> Iterator[dict]:
    """Blocks from last to first: the vector at each one's end."""
    conversation, vector, first = None, edit_path.END, True
    for row in rows:
        last = first or row["conv_id"] != conversation
        if last:
            conversation, vector, first = row["conv_id"], edit_path.END, False
        yield {"part": row["part"], "number": row["number"], "end": list(vector), "last": last}
        vector = edit_path.through(row["matrix"], vector)


def _walks(rows: Iterable[dict]) -> Iterator[dict]:
    """Each block walked from all four states."""
    for row in rows:
        end = tuple(row["end"])
        found = [edit_path.walk(row["codes"], state, end) for state in range(4)]
        tails = [edit_path.closing(state) if row["last"] else "" for _, state, _ in found]
        yield row | {
            "pieces": [edits + tail for (edits, _, _), tail in zip(found, tails)],
            "exits": [state for _, state, _ in found], "costs": [int(cost) for _, _, cost in found],
        }


def _chain(rows: Iterable[dict]) -> Iterator[dict]:
    """Blocks from first to last: the state each one begins in, and sums up to it."""
    sums: dict | None = None
    for row in rows:
        if sums is None or row["conv_id"] != sums["conv_id"]:
            sums = row | {"entry": edit_path.START, "cost": row["costs"][edit_path.START]}
        else:
            sums = sums | {"part": row["part"], "number": row["number"], "entry": sums["exit"]}
            for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
                sums[name] += row[name]
            if row["first_code"] is not None:
                sums["illegal"] += sums["last_code"] is not None and (sums["last_code"], row["first_code"]) not in _LEGAL
                sums["last_code"] = row["last_code"]
            if row["first_turn"] is not None:
                sums["turns"] -= sums["last_turn"] == row["first_turn"]
                sums["first_turn"] = row["first_turn"] if sums["first_turn"] is None else sums["first_turn"]
                sums["last_turn"] = row["last_turn"]
        sums["exit"] = row["exits"][sums["entry"]]
        yield sums


def _applied(rows: Iterable[dict]) -> Iterator[dict]:
    for row in rows:
        row["edits"] = row["pieces"][row["entry"]]
        turns = ((code, line["role"], line["text"]) for code, line in zip(row["codes"], row["lines"]))
        row["lines"] = [{"role": r, "text": t} for r, t in edit_path.apply(row["edits"], turns, row["entry"])]
        yield row


def repair(rows: DataFrame, block_turns: int = BLOCK_TURNS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The cheapest repair of each conversation of ``rows`` (conv_id, turn, role, text, dropped), in blocks.

    Blocks of a conversation are ordered by (part, number). ``lines`` are a block's repaired turns and ``edits`` its
    edits; the sums (``blank`` to ``last_turn``, ``cost``) are those of the conversation where ``last`` is true.
    Rows that ``dropped`` marks count for their conversation's existence alone. The result is stored.
    """
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    conv = f"conv_id {types['conv_id']}, part int, number int"
    stats = _STATS.format(turn=types["turn"])
    ddl = f"{conv}, whole boolean, codes binary, lines {_LINES}, {stats}, matrix array<double>, edits string, cost bigint"
    wanted = T.StructType.fromDDL(ddl)
    blocks = materialize(_in_order(rows).mapInArrow(_blocks(to_arrow_schema(wanted), block_turns, block_bytes), wanted), "blocks")
    sums = ["turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "cost"]
    shown = ["conv_id", "part", "number", "whole", "last", "edits", "lines", *sums]
    whole = blocks.filter("whole").withColumn("last", F.lit(True)).select(*shown)
    parts = blocks.filter("not whole")
    if parts.isEmpty():
        return whole
    ends = _mapped(
        _together(parts.select("conv_id", "part", "number", "matrix"), F.desc("part"), F.desc("number")),
        _ends, "part int, number int, end array<double>, last boolean",
    )
    walked = materialize(
        _mapped(
            parts.drop("matrix", "whole", "edits", "cost").join(ends, ["part", "number"]),
            _walks, f"{conv}, codes binary, lines {_LINES}, {stats}, last boolean, pieces array<string>, exits array<int>, costs array<bigint>",
        ),
        "walked",
    )
    names = [f.name for f in T.StructType.fromDDL(stats).fields]
    chained = _mapped(
        _together(walked.select("conv_id", "part", "number", *names, "exits", "costs"), "part", "number"),
        _chain, f"part int, number int, entry int, {stats}, cost bigint",
    )
    solved = _mapped(
        walked.select("conv_id", "part", "number", "last", "codes", "lines", "pieces").join(chained, ["part", "number"]),
        _applied, f"{conv}, last boolean, edits string, lines {_LINES}, {stats}, cost bigint",
    )
    return whole.unionByName(materialize(solved.withColumn("whole", F.lit(False)).select(*shown), "repaired"))


def turns(repaired: DataFrame) -> DataFrame:
    """``conv_id, block, place, role, text``: the turns of repaired conversations, in order of (block, place)."""
    block = F.struct("part", "number").alias("block")
    return repaired.select("conv_id", block, F.posexplode("lines").alias("place", "line")).select(
        "conv_id", "block", "place", "line.role", "line.text"
    )


def _digests(rows: Iterable[dict]) -> Iterator[dict]:
    """Blocks from first to last: digest and edits of the whole conversation, with its last block."""
    digest, edits, begun = hashlib.sha256(), [], False
    for row in rows:
        if row["body"] is not None:
            digest.update((("\n" if begun else "") + row["body"]).encode("utf-8", "surrogatepass"))
            begun = True
        edits.append(row["edits"])
        if row["last"]:
            yield row | {"audit": "".join(edits), "repaired_sha256": digest.hexdigest()}
            digest, edits, begun = hashlib.sha256(), [], False


def audit(repaired: DataFrame) -> DataFrame:
    """One row per conversation: faults found, cost and edits of its repair, and the digest of its repaired turns."""
    told = F.transform("lines", lambda line: F.concat(line["role"], F.lit(":"), line["text"]))
    body = F.when(F.size("lines") > 0, F.array_join(told, "\n"))
    sums = ["turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = repaired.filter("whole").select(
        "conv_id", *sums, F.col("edits").alias("audit"),
        F.sha2(F.coalesce(body, F.lit("")).cast("binary"), 256).alias("repaired_sha256"),
    )
    parts = repaired.filter("not whole").select("conv_id", "part", "number", "last", "edits", *sums, body.alias("body"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in whole.schema.fields)
    both = whole.unionByName(_mapped(_together(parts, "part", "number"), _digests, kinds))
    gaps = F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns")
    return both.select(
        "conv_id", F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    )
