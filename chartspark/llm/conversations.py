"""Conversation structure repair: the cheapest edits that make turns alternate, found by integers that carry cost and letters."""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chartspark.llm.common import SPACE, in_arrow

#: Costs of edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Conversations of the roles' initials that are wanted: (s?(ua)+)?, as (state, initial): state. Ends in EMPTY or FULL.
EMPTY, SYSTEM, USER, FULL = range(4)
STEPS = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (FULL, "u"): USER, (USER, "a"): FULL}
#: What a row may be given or a new row has.
ROLES = {"u": "user", "a": "assistant"}
#: The letters of edits, in the order of ASCII; 0 is the padding.
LETTERS = "\0DIKR"
BITS = 3
#: New rows in one gap. More are never among the cheapest edits: two letters lead from a state back to itself.
IN_A_GAP = 2


def cheapest(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """(cost, letters) of the cheapest edits of a conversation; of several the least letters in the order of ASCII.

    ``rows`` are (initial of the role, has to go, is truncated). What is still to come after a row is one integer for
    each state: the cost in the high digits; below it the letters, one digit each from the highest of ``width`` places
    on, padded with zeros at the end. An edit adds its cost, moves the letters one place down and puts its own in front,
    so the least integer is the least cost and then the least letters, and ordinary ``min`` decides everything. No
    conversation needs as many letters as there are places, so only padding is moved out.
    """
    width = (len(rows) + (len(rows) + 1) * IN_A_GAP + 1) * BITS
    front = {letter: LETTERS.index(letter) << (width - BITS) for letter in "DIKR"}
    low = (1 << width) - 1

    def edited(rest: int, letter: str, cost: int) -> int:
        return ((rest >> width) + cost << width) | front[letter] | ((rest & low) >> BITS)

    def gap(after: dict[int, int]) -> dict[int, int]:
        best = after
        for _ in range(IN_A_GAP):
            found = dict(after)
            for (state, initial), then in STEPS.items():
                if initial in ROLES and then in best:
                    value = edited(best[then], "I", INSERT)
                    found[state] = min(value, found.get(state, value))
            best = found
        return best

    rest = gap({EMPTY: 0, FULL: 0})
    for initial, goes, truncated in reversed(rows):
        before = {state: edited(value, "D", DELETE) for state, value in rest.items()}
        for (state, wanted), then in STEPS.items():
            if goes or then not in rest:
                continue
            for letter, cost in (("K", KEEP),) * (initial == wanted) + (("R", REROLE),) * (wanted in ROLES):
                value = edited(rest[then], letter, cost + TRUNCATED * truncated)
                before[state] = min(value, before.get(state, value))
        rest = gap(before)
    best = rest[EMPTY]
    digits = range(width - BITS, -1, -BITS)
    return best >> width, "".join(LETTERS[(best >> at) & 7] for at in digits).rstrip("\0")


def repaired(rows, letters: str):
    """The (role, text) that the edits leave of the (role, text) in ``rows``, one after the other."""
    rows, state = iter(rows), EMPTY
    for letter in letters:
        role, text = (None, "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        initial = role[:1] if letter == "K" else "a" if state == USER else "u"
        state = STEPS[state, initial]
        yield role if letter == "K" else ROLES[initial], text


def damaged(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, stays, turn, role, text): rows spoilt by a hash of conversation and turn. NULLs count as one space."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in (conversation, turn)))
    rows = rows.select(
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), blank).alias("role"),
        F.coalesce(F.col(text), blank).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("how"),
    )
    how = F.col("how")
    spoilt = F.when(how == 1, "").when(how == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(how == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select(
        "conv",
        (how != 0).alias("stays"),
        "turn",
        F.when(how == 4, "user").otherwise(F.col("role")).alias("role"),
        spoilt.alias("text"),
        copies.alias("copy"),
    ).drop("copy")


def as_they_are(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, stays, turn, role, text) of conversations that are repaired as they are. NULLs count as one space."""
    kept = (F.coalesce(F.col(c), F.lit(" ")).alias(name) for c, name in ((role, "role"), (text, "text")))
    return rows.select(F.col(conversation).alias("conv"), F.lit(True).alias("stays"), F.col(turn).alias("turn"), *kept)


def _last(text: Column) -> Column:
    """The last character that is no white space; empty where there is none."""
    return F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))


def _said(role: str, text: str) -> Column:
    """128 bits that stand for role and text."""
    return F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def _in_order(rows: DataFrame, *order: str) -> DataFrame:
    """The rows of a conversation one after the other in one task; a sort on disk where they are many."""
    return rows.repartition("conv").sortWithinPartitions("conv", *order)


def _conversations(batches, columns):
    """(conversation, iterator of its rows) from batches sorted by conversation; each iterator has to be used up."""
    stream = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
    row = next(stream, None)

    def members(name):
        nonlocal row
        while row is not None and row[0] == name:
            yield row[1:]
            row = next(stream, None)

    while row is not None:
        yield row[0], members(row[0])


HEAD = {"gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "cost": "long", "audit": "string"}
FOUND = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
#: Rows of a batch that is given back.
BATCH = 4096


def _in_batches(rows, schema: pa.Schema):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _arrow(schema, type_) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def plans(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation in :func:`damaged` rows.

    A row of the shuffle has a role's initial, flags and a hash, but no text.
    """
    last = _last(F.col("text"))
    facts = rows.select(
        "conv",
        "turn",
        F.col("role"),
        _said("role", "text").alias("said"),
        "stays",
        F.substring("role", 1, 1).alias("initial"),
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("truncated"),
    )
    schema = facts.select("conv").schema
    for name, kind in HEAD.items():
        schema = schema.add(name, kind)
    sent = _arrow(schema, None)

    def plan(batches):
        def found():
            for conv, members in _conversations(batches, ["conv", "stays", "turn", "initial", "said", "blank", "truncated"]):
                turns, said, steps = set(), set(), []
                blank = duplicate = truncated = illegal = 0
                for stays, turn, initial, what, is_blank, is_cut in members:
                    if not stays:
                        continue
                    turns.add(turn)
                    again = what in said
                    said.add(what)
                    cut = is_cut and not is_blank and not again
                    if steps and steps[-1][0] + initial not in ("su", "ua", "au"):
                        illegal += 1
                    blank += is_blank
                    duplicate += again and not is_blank
                    truncated += cut
                    steps.append((initial, is_blank or again, cut))
                turns.discard(None)
                gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
                yield (conv, gaps, blank, duplicate, truncated, illegal, *cheapest(steps))

        return _in_batches(found(), sent)

    return in_arrow(_in_order(facts, "turn", "role", "said"), plan, schema)


def _with_plans(rows: DataFrame) -> DataFrame:
    """The rows of each conversation in order, and before them one with its plan."""
    head = plans(rows).withColumn("part", F.lit(0))
    body = rows.filter("stays").select("conv", "turn", "role", _said("role", "text").alias("said"), "text", F.lit(1).alias("part"))
    return _in_order(head.unionByName(body, allowMissingColumns=True), "part", "turn", "role", "said")


def repaired_rows(rows: DataFrame) -> DataFrame:
    """(conv, place, role, text): the repaired conversations, rows numbered from 0, of :func:`damaged` rows."""
    ordered = _with_plans(rows)
    schema = ordered.select("conv").schema.add("place", "long").add("role", "string").add("text", "string")
    sent = _arrow(schema, None)

    def mend(batches):
        def rows():
            for conv, members in _conversations(batches, ["conv", "audit", "role", "text"]):
                letters = next(members)[0]
                for place, (role, text) in enumerate(repaired(((r, t) for _, r, t in members), letters)):
                    yield conv, place, role, text
                for _ in members:
                    pass

        return _in_batches(rows(), sent)

    return in_arrow(ordered, mend, schema)


def repair_report(rows: DataFrame) -> DataFrame:
    """Every conversation of :func:`damaged` rows with its faults, plan, and SHA-256 of the repaired text.

    Columns: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. A row is taken as the first
    that applies of blank (nothing but white space), duplicate (role and text were there before) and truncated (the last
    character but white space is none of ``.!?``). The rows are taken by turn, NULLs first, then by role and a hash of
    role and text, so that equal rows stand together. ``gaps`` are the turns missing between the first and the last;
    ``illegal`` counts neighbours whose initials are not su, ua or au.

    The edits K (keep), R (give another role), D (delete; blank and duplicate rows have to go) and I (insert an empty
    row) lead to initials ``(s?(ua)+)?`` at the least cost, ties to the least letters; see :func:`cheapest`. A NULL or
    an empty role has to be given another or go. A conversation of which no row stays has zeros, no letters and the
    hash of nothing; NULL conversations are one. Conversations are streamed in order: a task holds a few bytes a row,
    and never the texts of one. The integers grow with a conversation, so its time does with the square of its rows. An
    empty table gives an empty result.
    """
    ordered = _with_plans(rows)
    schema = ordered.select("conv", *FOUND).schema.add("repaired_sha256", "string")
    sent = _arrow(schema, None)

    def report(batches):
        def rows():
            for conv, members in _conversations(batches, ["conv", *FOUND, "role", "text"]):
                head = next(members)[: len(FOUND)]
                digest, between = hashlib.sha256(), ""
                for role, text in repaired((m[-2:] for m in members), head[-1]):
                    digest.update(f"{between}{role}:{text}".encode())
                    between = "\n"
                for _ in members:
                    pass
                yield (conv, *head, digest.hexdigest())

        return _in_batches(rows(), sent)

    return in_arrow(ordered, report, schema)
