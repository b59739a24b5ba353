"""Conversation structure repair.

Every row of a conversation is kept, given another role, or deleted, and
turns are inserted, so that the roles read ``(s?(ua)+)?`` (by initials) at
the least cost; of equally cheap repairs the one whose audit (the edits'
initials in order) is least in ASCII order wins.

The choice is a shortest path in a DAG.  A node is (row, last role kept);
an edge is one row's edit with the insertions before it.  A path's weight
is one integer: the cost in its high digits, and below them a digit of
three bits for each audit letter, the first letter highest, zero where the
audit has ended.  The order of such integers is the order wanted (cost,
then audit, a prefix first), so the DP only takes minima of integers.
Working from the last row to the first, putting a letter before a path
moves its letters down one digit.  A conversation is cut into blocks of
``BLOCK`` rows, whose last nodes start from the costs of the next block:
integers stay short, the work linear.  That is exact: paths over the same
rows that end in an edit of a row are no prefixes of each other, so where
their letters differ at all they differ within the block.

On Spark: rows get their place in the conversation from a range sort that
can cut a conversation over tasks (``row_number_skew_safe``); which rows
repeat earlier ones is an aggregate by text digest and a join on (id,
place).  A conversation is then one byte a row, gathered in strings of
``BLOCK`` rows and those by conversation: less than the audit that is
returned in one row anyway.  Texts never meet in memory: they are sorted
once by (conversation, place) with the audits of their blocks, and
streamed through SHA-256, whose order alone makes one task read one
conversation.

Defined results.  Null id, role or text read as one space; a null turn
counts as one space in the damage and sorts first.  A null id is a
conversation of its own, returned with a null id.  Rows of equal turn: by
role, then text, copies side by side.  A role without a letter (empty)
has no initial, so its row can't be kept; other roles count by their
first character as it is written.  Blank rows have no character that is
not ASCII white space.  Repeated rows are rows.  Very long texts are read
whole.  Empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import cut_lineage, written
from ledgerline.operators.windows import row_number_skew_safe

BLOCK = 256
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5

# Audit letters in ASCII order; 0 is the padding.
LETTERS = "\0DIKR"
D, I, K, R = range(1, 5)
DIGIT = 3  # bits
MOST_INSERTS = 2  # three lead where one leads
WIDTH = DIGIT * (BLOCK + 1) * (MOST_INSERTS + 1)
LOW = (1 << WIDTH) - 1
NEVER = 1 << 60  # a cost that no repair has

# States: nothing kept yet, then the initial of the last role kept.
START, S, U, A = range(4)
NEXT = {START: U, S: U, A: U, U: A}  # what an insertion or a new role adds
KEEPS = {"s": {START: S}, "u": {START: U, S: U, A: U}, "a": {U: A}}
ROLES = {U: "user", A: "assistant"}
FOLLOWS = {"su", "ua", "au"}

# A row in one character: its initial (s, u, a or other) and its first fault.
INITIALS, FAULTS = "sua-", ("", "blank", "duplicate", "truncated")
CODES = "abcdefghijklmnop"  # position: initial * 4 + fault


def _code(initial: str, fault: str = "") -> str:
    return CODES[INITIALS.index(initial) * 4 + FAULTS.index(fault)]


def _edits(code: str) -> list[tuple[int, int, dict[int, int]]]:
    """(letter, cost, state before -> state after) of a row."""
    number = CODES.index(code)
    initial, fault = INITIALS[number // 4], FAULTS[number % 4]
    edits = [(D, DELETE, {s: s for s in NEXT})]
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED if fault == "truncated" else 0
        edits += [(K, extra, KEEPS.get(initial, {})), (R, REROLE + extra, NEXT)]
    return edits


EDITS = {c: _edits(c) for c in CODES}


def _before(weight: int, letter: int, cost: int) -> int:
    """The weight of a path with one more letter before it."""
    return (((weight >> WIDTH) + cost) << WIDTH) | (letter << (WIDTH - DIGIT)) | ((weight & LOW) >> DIGIT)


def _with_inserts(weights: list[int]) -> list[int]:
    """The least weights if turns may be inserted first."""
    for _ in range(MOST_INSERTS):
        weights = [min(weights[s], _before(weights[NEXT[s]], I, INSERT)) for s in range(4)]
    return weights


def block_weights(codes: str, weights: list[int]) -> list[int]:
    """Least weight from each state before the block's first row, given
    the weights after its last."""
    for code in reversed(codes):
        here = [NEVER << WIDTH] * 4
        for letter, cost, step in EDITS[code]:
            for before, after in step.items():
                here[before] = min(here[before], _before(weights[after], letter, cost))
        weights = _with_inserts(here)
    return weights


def _letters(weight: int) -> str:
    out, shift = [], WIDTH
    while shift and (digit := (weight >> (shift := shift - DIGIT)) & 7):
        out.append(LETTERS[digit])
    return "".join(out)


def roles_of(audit: str, codes: str, state: int) -> tuple[list[int], int]:
    """The state after each edit of the audit (deletions leave it)."""
    states, row = [], 0
    for letter in audit:
        if letter in "IR":
            state = NEXT[state]
        elif letter == "K":
            state = KEEPS[INITIALS[CODES.index(codes[row]) // 4]][state]
        row += letter != "I"
        states.append(state)
    return states, state


def _repair(codes: str) -> tuple[int, tuple[str, ...]]:
    blocks = [codes[n:n + BLOCK] for n in range(0, len(codes), BLOCK)]
    # After the last row: an alternation that is over, or turns inserted to its end.
    weights = _with_inserts([0, NEVER << WIDTH, NEVER << WIDTH, 0])
    chosen = []
    for number in range(len(blocks) - 1, -1, -1):
        if number < len(blocks) - 1:
            weights = [w >> WIDTH << WIDTH for w in weights]  # the next block's letters are its own
        weights = block_weights(blocks[number], weights)
        chosen.append(weights)
    state, audits = START, []
    for block, weights in zip(blocks, reversed(chosen)):
        audits.append(_letters(weights[state]))
        state = roles_of(audits[-1], block, state)[1]
    return (chosen[-1][START] >> WIDTH if chosen else 0), tuple(audits)


_repair_short = functools.lru_cache(maxsize=1 << 16)(_repair)


def repair(codes: str) -> tuple[int, tuple[str, ...]]:
    """(cost, audit of each block) of the cheapest repair."""
    return _repair_short(codes) if len(codes) <= 32 else _repair(codes)


def damaged(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copy) after the contract's damage."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    body = F.when(hit == 1, "").when(hit == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text"))
    return rows.select(
        text("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.when(hit == 4, "user").otherwise(text("role")).alias("role"), body.alias("text"), hit.alias("hit"),
    ).where("hit <> 0").select(
        "conv", "turn", "role", "text",
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def placed(rows: DataFrame) -> DataFrame:
    """The rows with their place in the conversation, from 0."""
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc(), F.col("copy").asc()]
    numbered = row_number_skew_safe(rows, "conv", order, "place")
    return written(numbered.select("conv", "turn", "role", "text", (F.col("place") - 1).alias("place")), "conversations")


def _fault_codes(role: Column, blank: Column, repeated: Column, truncated: Column) -> Column:
    kinds = [F.when(blank, _code(i, "blank")).when(repeated, _code(i, "duplicate"))
             .when(truncated, _code(i, "truncated")).otherwise(_code(i)) for i in INITIALS]
    initial = F.substring(role, 1, 1)
    return F.when(initial == "s", kinds[0]).when(initial == "u", kinds[1]).when(initial == "a", kinds[2]).otherwise(kinds[3])


def coded(rows: DataFrame) -> DataFrame:
    """(conv, block, codes): the rows' codes in order, ``BLOCK`` a string."""
    body = F.rtrim(F.col("text"), F.lit(" \t\n\v\f\r"))
    slim = rows.select("conv", "place", "role", F.sha2("text", 256).alias("digest"), (body == "").alias("blank"),
                       (~F.substring(body, -1, 1).isin(".", "!", "?")).alias("truncated"))
    first = slim.groupBy("conv", "role", "digest").agg(F.min("place").alias("place")).select(
        "conv", "place", F.lit(True).alias("first"))
    marked = slim.join(first, ["conv", "place"], "left")
    code = _fault_codes(F.col("role"), F.col("blank"), F.col("first").isNull(), F.col("truncated"))
    block = (F.col("place") / BLOCK).cast("long").alias("block")
    return marked.select("conv", block, "place", code.alias("code")).groupBy("conv", "block").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "code"))), lambda x: x["code"]), "")
        .alias("codes"))


def decided(codes: DataFrame) -> DataFrame:
    """(conv, counts, cost, audits) of each conversation; ``audits`` has
    a string for each block."""
    whole = codes.groupBy("conv").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("block", "codes"))), lambda x: x["codes"]), "").alias("codes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        initials = {c: INITIALS[n // 4] for n, c in enumerate(CODES)}
        counted = {f: [_code(i, f) for i in INITIALS] for f in FAULTS[1:]}
        for batch in batches:
            out = []
            for row in batch.column("codes").to_pylist():
                cost, audits = repair(row)
                roles = [initials[c] for c in row]
                illegal = sum(a + b not in FOLLOWS for a, b in zip(roles, roles[1:]))
                out.append((*(sum(map(row.count, cs)) for cs in counted.values()), illegal, cost, list(audits)))
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), *(pa.array(c, pa.int64()) for c in columns[:5]),
                 pa.array(columns[5], pa.list_(pa.string()))],
                ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audits"])

    return whole.mapInArrow(run, "conv string, blank long, duplicate long, truncated long, illegal long, cost long, "
                                 "audits array<string>")


def digests(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """(conv, sha256): of each repaired conversation with rows.  Sorted
    by conversation and place, each block's audit before its rows."""
    audits = decisions.select("conv", F.posexplode("audits").alias("block", "audit"))
    audits = audits.select("conv", (F.col("block").cast("long") * BLOCK).alias("place"), F.lit(0).alias("kind"),
                           F.lit("").alias("role"), F.col("audit").alias("text"))
    stream = audits.unionByName(rows.select("conv", "place", F.lit(1).alias("kind"), "role", "text"))
    stream = stream.repartition(F.col("conv")).sortWithinPartitions("conv", "place", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, lines, digest, audit, used = None, START, 0, hashlib.sha256(), "", 0

        def line(role: str, text: str) -> None:
            nonlocal lines
            digest.update((("\n" if lines else "") + role + ":" + text).encode())
            lines += 1

        def inserted() -> None:
            nonlocal used, state
            while audit[used:used + 1] == "I":
                state, used = NEXT[state], used + 1
                line(ROLES[state], "")

        for batch in batches:
            done = []
            for conv, kind, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "kind", "role", "text"))):
                if conv != at:
                    if at is not None:
                        inserted()
                        done.append((at, digest.hexdigest()))
                    at, state, lines, digest = conv, START, 0, hashlib.sha256()
                if kind == 0:
                    audit, used = text, 0
                    continue
                inserted()
                edit, used = audit[used], used + 1
                if edit == "R":
                    state = NEXT[state]
                    line(ROLES[state], text)
                elif edit == "K":
                    state = KEEPS[role[0]][state]
                    line(role, text)
            yield pa.RecordBatch.from_arrays([pa.array([d[n] for d in done], pa.string()) for n in range(2)],
                                             ["conv", "sha256"])
        if at is not None:
            inserted()
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([digest.hexdigest()])], ["conv", "sha256"])

    return stream.mapInArrow(run, "conv string, sha256 string")


def repair_report(table: DataFrame) -> DataFrame:
    """Damages the conversations as the contract says, repairs them, and
    returns counts, cost, audit and digest of each."""
    rows = placed(damaged(table.select("conv_id", "turn", "role", "text")))
    decisions = cut_lineage(decided(coded(rows)))
    turns = rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    every = table.select(F.col("conv_id").cast("long").alias("conv_id"),
                         F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    found = every.join(decisions, "conv", "left").join(turns, "conv", "left").join(digests(rows, decisions), "conv", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return found.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.array_join("audits", ""), F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
