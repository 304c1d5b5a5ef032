"""Repair of conversations whose rows are missing, empty, cut, repeated or mislabelled.

Rows are sorted once over the whole table by conversation and turn, and numbered by that order. What
an edit can cost at a row depends on one byte (role initial and fault), so the search for the cheapest
repair (``auction``) needs neither texts nor whole conversations: a task reads a stretch of the sorted
rows and makes blocks of bounded length. A conversation that is longer than a block, or lies over two
tasks, is joined from its blocks' crossing costs; its texts then pass in order, row by row, under the
letters found for them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stage
from . import auction
from .common import ship_code, sized_join

BLOCK = 16_384  # rows of one conversation searched at a time
_SPACE = " \t\n\x0b\f\r"
_CONV, _NTH = ("conv_id", pa.int64()), ("nth", pa.int32())
_BLOCK_SCHEMA = (
    "conv_id long, pos long, codes binary, first_initial int, last_initial int, illegal long"
)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after the damage that their checksums name: dropped,
    emptied, without sentence ends, repeated or with role user. Nulls in the texts and in what the
    checksum reads are one space."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), spaced("role").alias("role"),
        spaced("text").alias("text"), fate.alias("fate"),
    ).filter("fate <> 0")
    copies = F.when(F.col("fate") == 3, 2).otherwise(1)
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", ""))
    return rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
    ).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``pos``, which counts by conversation and turn (nulls first); rows of one turn
    follow by role and text. Written once; a conversation may lie over several files."""
    keys = ["conv_id", "turn", "role", "text", "__tie"]
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())  # splits even equal rows
    placed = tied.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(
        placed.select(
            "conv_id", F.monotonically_increasing_id().alias("pos"), "turn", "role", "text"
        ),
        "turns",
    )


def initial(role: Column) -> Column:
    """The initial's number in ``auction.INITIALS``, 3 for any other."""
    place = F.call_function("instr", F.lit(auction.INITIALS), F.substring(role, 1, 1))
    return F.when((place > 0) & (role != ""), place - 1).otherwise(3)


def faults(turns: DataFrame) -> DataFrame:
    """conv_id, pos, turn, initial and fault of each row: blank, duplicate, truncated or null. Rows of
    one role and text are told by a digest; only digests that occur twice are joined back."""
    end = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    same = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.length("role"), "role", "text")
    facts = stage(
        turns.select(
            "conv_id", "pos", "turn", initial(F.col("role")).cast("int").alias("initial"),
            (F.translate("text", _SPACE, "") == "").alias("blank"),
            (~end.isin(".", "!", "?")).alias("truncated"), F.unhex(F.md5(same)).alias("same"),
        ),
        "turn-facts",
    )
    repeated = stage(
        facts.groupBy("same").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1")
        .select(F.col("same").alias("again"), "first"),
        "repeated-turns",
    )
    seen = sized_join(facts, repeated, [F.col("same") == F.col("again")], "left")
    fault = (
        F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate")
        .when(F.col("truncated"), "truncated")
    )
    return stage(seen.select("conv_id", "pos", "turn", "initial", fault.alias("fault")), "faults")


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, (_, kind) in zip(columns, fields, strict=True)],
        [name for name, _ in fields],
    )


def _each(
    df: DataFrame, made: Callable[..., tuple], schema: str, fields: list[tuple[str, pa.DataType]]
) -> DataFrame:
    """conv_id and nth of each row of ``df``, and what ``made`` gives for its other columns."""

    def batches(held: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in held:
            columns = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield _batch([(conv, nth, *made(nth, *rest)) for conv, nth, *rest in columns], fields)

    return df.mapInArrow(batches, schema)


def blocks(rows: DataFrame) -> DataFrame:
    """Rows in order as blocks of at most BLOCK rows of one conversation: its number among the
    conversation's blocks (``nth``, from 0), how many there are, and the bytes of its rows."""
    code = F.col("initial") * auction.FAULTS + (
        F.when(F.col("fault").isNull(), auction.FINE)
        .when(F.col("fault") == "truncated", auction.TRUNCATED).otherwise(auction.MUST_GO)
    )
    fields = [
        _CONV, ("pos", pa.int64()), ("codes", pa.binary()), ("first_initial", pa.int32()),
        ("last_initial", pa.int32()), ("illegal", pa.int64()),
    ]

    def block(conv, pos, codes) -> tuple:
        own = [c // auction.FAULTS for c in codes]
        illegal = sum(p not in auction.LEGAL_PAIRS for p in zip(own, own[1:], strict=False))
        return conv, pos, bytes(codes), own[0], own[-1], illegal

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, pos, codes = None, 0, bytearray()
        for batch in batches:
            out = []
            for c, at, value in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if codes and (c != conv or len(codes) == BLOCK):
                    out.append(block(conv, pos, codes))
                    codes = bytearray()
                if not codes:
                    conv, pos = c, at
                codes.append(value)
            yield _batch(out, fields)
        if codes:
            yield _batch([block(conv, pos, codes)], fields)

    sorted_rows = (
        rows.select("conv_id", "pos", code.cast("int").alias("code"))
        .repartitionByRange("pos").sortWithinPartitions("pos")
    )
    of_conversation = Window.partitionBy("conv_id")
    before = F.lag("last_initial").over(of_conversation.orderBy("pos"))
    pair = F.concat_ws(",", before, "first_initial")
    legal = [f"{a},{b}" for a, b in sorted(auction.LEGAL_PAIRS)]
    return stage(
        sorted_rows.mapInArrow(gather, _BLOCK_SCHEMA).select(
            "conv_id", "codes",
            (F.col("illegal") + F.when(before.isNotNull() & ~pair.isin(legal), 1).otherwise(0)).alias("illegal"),
            (F.row_number().over(of_conversation.orderBy("pos")) - 1).alias("nth"),
            F.count("*").over(of_conversation).alias("blocks"),
        ),
        "turn-blocks",
    )


def _priced(whole: DataFrame) -> DataFrame:
    """(conv_id, nth, cost, audit) of conversations that are one block."""

    def solve(_, codes: bytes) -> tuple[int, str]:
        lattice = auction.Lattice(codes)
        return lattice.distance(auction.START), lattice.repair(auction.START)[0]

    return _each(
        whole.select("conv_id", "nth", "codes"), solve, "conv_id long, nth int, cost long, audit string",
        [_CONV, _NTH, ("cost", pa.int64()), ("audit", pa.string())],
    )


def _joined(parts: DataFrame) -> DataFrame:
    """(conv_id, nth, cost, audit) of the blocks of longer conversations; a conversation's cost stands
    at its first block. Between tasks go 16 costs a block, then four, then its letters."""
    rows = parts.select("conv_id", "nth", "blocks", "codes")

    costs = stage(
        _each(
            rows.select("conv_id", "nth", "codes"), lambda _, codes: (sum(auction.crossing(codes), []),),
            "conv_id long, nth int, crossing array<int>",
            [_CONV, _NTH, ("crossing", pa.list_(pa.int32()))],
        ),
        "crossings",
    )

    def back(own: pd.DataFrame) -> pd.DataFrame:
        # From the last block to the first: what leaving a block costs, less the least of it.
        own = own.sort_values("nth", ascending=False)
        leave, spent, out = list(auction.ACCEPTED), 0, []
        size = auction.STATES
        # Behind the last block turns may be inserted before the end.
        ahead = auction.Lattice(b"", leave)
        leave = [ahead.distance(s) for s in range(size)]
        for nth, crossing in zip(own["nth"], own["crossing"], strict=True):
            out.append((nth, [None if x is None else int(x) for x in leave], spent))
            flat = [None if pd.isna(x) else int(x) for x in crossing]
            enter = []
            for s in range(size):
                ways = [
                    flat[s * size + q] + leave[q]
                    for q in range(size) if flat[s * size + q] is not None and leave[q] is not None
                ]
                enter.append(min(ways, default=None))
            low = min(x for x in enter if x is not None)
            spent += low
            leave = [None if x is None else x - low for x in enter]
        frame = pd.DataFrame(out, columns=["nth", "leave", "behind"])
        frame.insert(0, "conv_id", pd.Series([own["conv_id"].iloc[0]] * len(frame), dtype="Int64"))
        return frame

    exits = stage(
        costs.groupBy("conv_id").applyInPandas(
            back, "conv_id long, nth int, leave array<int>, behind long"
        ),
        "block-exits",
    )
    with_exits = rows.join(
        exits.withColumnsRenamed({"conv_id": "__conv", "nth": "__nth"}),
        F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("nth") == F.col("__nth")),
    )

    def trace(nth: int, n: int, codes: bytes, leave: list, behind: int) -> tuple:
        last = nth == n - 1
        lattice = auction.Lattice(codes, auction.ACCEPTED if last else leave, last)
        ways = []
        for s in range(auction.STATES):
            cost = lattice.distance(s)
            ways.append((None, None, None) if cost is None else (cost, *lattice.repair(s)))
        return behind, *map(list, zip(*ways, strict=True))

    traced = stage(
        _each(
            with_exits.select("conv_id", "nth", "blocks", "codes", "leave", "behind"), trace,
            "conv_id long, nth int, behind long, costs array<int>, letters array<string>, leaves array<int>",
            [
                _CONV, _NTH, ("behind", pa.int64()), ("costs", pa.list_(pa.int32())),
                ("letters", pa.list_(pa.string())), ("leaves", pa.list_(pa.int32())),
            ],
        ),
        "block-repairs",
    )

    def choose(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("nth")
        state, out = auction.START, []
        for leaves in own["leaves"]:
            out.append(state)
            state = int(leaves[state])
        return pd.DataFrame({"conv_id": own["conv_id"], "nth": own["nth"], "enter": out})

    entered = traced.select("conv_id", "nth", "leaves").groupBy("conv_id").applyInPandas(
        choose, "conv_id long, nth int, enter int"
    ).withColumnsRenamed({"conv_id": "__conv", "nth": "__nth"})
    way = F.col("enter") + 1
    return traced.join(
        entered, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("nth") == F.col("__nth"))
    ).select(
        "conv_id", "nth",
        F.when(F.col("nth") == 0, F.element_at("costs", way) + F.col("behind")).cast("long").alias("cost"),
        F.element_at("letters", way).alias("audit"),
    )


def audits(blocked: DataFrame) -> DataFrame:
    """(conv_id, cost, audit, illegal) per conversation with rows."""
    whole, parts = blocked.filter("blocks = 1"), blocked.filter("blocks > 1")
    pieces = _priced(whole).unionByName(_joined(parts))
    letters = F.array_sort(F.collect_list(F.struct("nth", "audit")))["audit"]
    found = pieces.groupBy("conv_id").agg(
        F.max("cost").alias("cost"), F.array_join(letters, "").alias("audit")
    )
    pairs = blocked.groupBy(F.col("conv_id").alias("__conv")).agg(F.sum("illegal").alias("illegal"))
    return stage(
        found.join(pairs, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv"), "audits"
    )


def _stream(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """Rows by conversation in order, each conversation led by a row with its audit and no role."""
    rows = turns.select("conv_id", "pos", "role", "text")
    lead = audited.select(
        "conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("role"),
        F.col("audit").alias("text"),
    )
    return lead.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "pos")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str | None, str | None, str]]:
    """(conv_id, role, text, letter) of the repaired turns; (conv_id, None, None, "") ends each
    conversation. One row at a time is held, and the letters of one conversation."""
    conv, audit, at, state, begun = None, "", 0, auction.START, False

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state = auction.FORCED[state]
            at += 1
            yield conv, auction.ROLE[state], "", "I"

    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in (0, 2, 3))
        for c, role, text in zip(*columns, strict=True):
            if role is None:
                if begun:
                    yield from inserted()
                    yield conv, None, None, ""
                conv, audit, at, state, begun = c, text, 0, auction.START, True
                continue
            yield from inserted()
            letter = audit[at]
            at += 1
            if letter == "K":
                number = auction.INITIALS.find(role[:1]) if role else 3
                state = auction.after_keep(state, number)
                yield c, role, text, "K"
            elif letter == "R":
                state = auction.FORCED[state]
                yield c, auction.ROLE[state], text, "R"
    if begun:
        yield from inserted()
        yield conv, None, None, ""


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired rows of ``conversations`` as they are given: conv_id, place (from 0), role, text and
    the edit that made each (K, R or I). Conversations without a row left have none."""
    ship_code(conversations.sparkSession)
    turns = ordered(conversations.select("conv_id", "turn", *[
        F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")
    ]))
    audited = audits(blocks(faults(turns)))

    fields = [
        _CONV, ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())
    ]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = [], 0
        for conv, role, text, letter in _edited(batches):
            if role is None:
                place = 0
                continue
            held.append((conv, place, role, text, letter))
            place += 1
            if len(held) == 1024:
                yield _batch(held, fields)
                held = []
        yield _batch(held, fields)

    return _stream(turns, audited).mapInArrow(
        rows, "conv_id long, place long, role string, text string, edit string"
    )


def _digests(stream: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the digest of ``role:text`` lines grows row by row."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, digests, running, first = [], [], hashlib.sha256(), True
        for conv, role, text, _ in _edited(batches):
            if role is None:
                convs.append(conv)
                digests.append(running.hexdigest())
                running, first = hashlib.sha256(), True
            else:
                running.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
        done = list(zip(convs, digests, strict=True))
        yield _batch(done, [_CONV, ("repaired_sha256", pa.string())])

    return stream.mapInArrow(digest, "conv_id long, repaired_sha256 string")


def repair_table(conversations: DataFrame) -> DataFrame:
    """Per conversation, after ``damage``: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit and repaired_sha256.

    Null roles and texts are one space, and a null conv_id names one conversation. Rows of one turn
    are ordered by role, then text; null turns come first and count in no gap. A conversation without
    rows after the damage has zeros, an empty audit and the digest of nothing. Empty input gives no
    rows; other columns are not read. The digest is one chain over a conversation's texts, so these
    pass through one task in order, a batch at a time; all else is done by blocks.
    """
    ship_code(conversations.sparkSession)
    ids = conversations.select(F.col("conv_id").cast("long")).distinct()
    turns = ordered(damage(conversations))
    faulty = faults(turns)
    audited = audits(blocks(faulty))
    by_turn = faulty.groupBy("conv_id", "turn").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counted = by_turn.groupBy(F.col("conv_id").alias("__counted")).agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"),
        *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")],
    )
    hashed = _digests(_stream(turns, audited)).withColumnRenamed("conv_id", "__hashed")
    audited = audited.withColumnRenamed("conv_id", "__audited")
    whole = ids
    for found, name in ((counted, "__counted"), (audited, "__audited"), (hashed, "__hashed")):
        whole = whole.join(found, F.col("conv_id").eqNullSafe(F.col(name)), "left")
    number = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return whole.select(
        "conv_id", *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
