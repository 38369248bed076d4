"""Conversation structure repair by iterative-deepening A*.

The turns of a conversation should read ``(s?(ua)+)?`` by the initials of their
roles (system, user, assistant). Each row's first fault counts: blank (nothing
but white space), duplicate (role and text seen earlier in the conversation),
truncated (the last visible character ends no sentence). Edits, in order along
the rows: Delete 3 (a blank or duplicate row has to go), Insert an empty turn
of the role that is due 2, Keep 0, Rerole to the role that is due 2; a truncated
row that stays costs 1 more. Sought are the cheapest edits, of several the ones
whose initials come first in ASCII order.

The search: a node is (rows read, role due: at the start, after system, after
user, after assistant). Depth-first search tries D, I, K, R in that order under
a bound on cost so far plus an estimate of what is left, and the bound grows by
one until a path is accepted: the first is the answer. A table holds for every
node the largest budget it has failed with, over all bounds, so a node is
entered again only with more. The estimate relaxes the task: rows of other
initials than the due one cost their edit or a flip of who speaks, and a system
row past the start costs a flip or not, as one likes, at 2; it never exceeds
the true cost and is found from behind in one go.

Rows are dealt out by ranges of (conv_id, turn, row), so a conversation of any
length lies in segments of bounded rows, in as many tasks as its rows need.
A segment that is no whole conversation gives the 4 x 4 costs from any state at
its start to any at its end; folding those from behind gives what each state at
its end still costs, with which each segment is searched alone (for each state
that it may begin in), and a fold from the front picks the state that it does
begin in. Both folds stream one small row per segment.

Defined results: null roles and texts count as one space; null conv_ids are one
conversation; rows without turn come first, rows of equal turn in stored order;
repeated rows are duplicates; an empty role has no initial and is never legal;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_features.llm.batches import map_rows
from cohort_features.llm.common import drop, join_small, numbered, store, with_group

WHITE = " \t\n\v\f\r"
ENDS = ".!?"
LEGAL = ("su", "ua", "au")
START, SYSTEM, USER, ASSISTANT = range(4)  # what was last: nothing, system, user, assistant
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1  # costs
DUE = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
FORCED, CUT = 4, 8  # bits of a row's code, above its initial (0 s, 1 u, 2 a, 3 other)
FAR = 1 << 30
#: what is left at the end of a conversation, by state; inserts are to come
GOAL = [0, 2 * INSERT, INSERT, 0]
SEGMENT_ROWS, SEGMENT_CHARS = 1024, 4 << 20


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by crc32 of ``conv_id:turn`` modulo 20: 0
    drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats
    it, 4 makes its role user. Stored."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("how"))
    rows = rows.filter("how <> 0").withColumn("copy", F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return store(rows.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text")), "damaged")


# --- one segment -------------------------------------------------------------


def code_of(role: str, text: str, duplicate: bool) -> tuple[int, str]:
    """A row's code and its fault."""
    initial = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
    shown = text.rstrip(WHITE)
    if not shown:
        return initial | FORCED, "blank"
    if duplicate:
        return initial | FORCED, "duplicate"
    return (initial, "") if shown[-1] in ENDS else (initial | CUT, "truncated")


def step(code: int, state: int, edit: str) -> tuple[int, int] | None:
    """Cost and next state of an edit of a row in a state, if it may be."""
    if edit == "D":
        return DELETE, state
    if edit == "I":
        return INSERT, DUE[state]
    if code & FORCED:
        return None
    late = TRUNCATED if code & CUT else 0
    if edit == "R":
        return REROLE + late, DUE[state]
    initial = code & 3
    if initial == 0:
        return (late, SYSTEM) if state == START else None
    return (late, DUE[state]) if initial == DUE[state] - 1 else None


def costs(codes: bytes) -> list[list[int]]:
    """Least cost from each state before the rows to each one after them
    (inserts come before a row, none after the last)."""
    left = [[0 if a == b else FAR for b in range(4)] for a in range(4)]
    for code in reversed(codes):
        new = []
        for state in range(4):
            row = [FAR] * 4
            for edit in "DKR":
                taken = step(code, state, edit)
                if taken:
                    row = [min(x, taken[0] + y) for x, y in zip(row, left[taken[1]], strict=True)]
            new.append(row)
        for _ in range(2):
            new = [[min(x, INSERT + y) for x, y in zip(new[s], new[DUE[s]], strict=True)] for s in range(4)]
        left = new
    return left


def through(matrix: list[list[int]], after: list[int]) -> list[int]:
    """What each state before a segment costs, given what each after it does."""
    return [min(a + b for a, b in zip(row, after, strict=True)) for row in matrix]


def estimates(codes: bytes, after: list[int]) -> list[tuple[int, int]]:
    """Per place: a lower bound of the cost left when user is due, and when
    assistant is. A system row may be taken to change who is due or not."""
    user, assistant = min(after[START], after[SYSTEM], after[ASSISTANT]), after[USER]
    out = [(user, assistant)]
    for code in reversed(codes):
        if code & FORCED:
            user, assistant = DELETE + user, DELETE + assistant
        else:
            late = TRUNCATED if code & CUT else 0
            initial = code & 3
            if initial == 0:
                user = assistant = REROLE + min(user, assistant)
            else:
                keep_user = late + (0 if initial == 1 else REROLE) + assistant
                keep_assistant = late + (0 if initial == 2 else REROLE) + user
                user, assistant = min(DELETE + user, keep_user), min(DELETE + assistant, keep_assistant)
        user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
        out.append((user, assistant))
    out.reverse()
    return out


def search(codes: bytes, begin: int = START, after: list[int] | None = None) -> tuple[str, int, int]:
    """Edits' initials, state at the end, and cost (of these rows). ``after``:
    what each state at the end still costs in later rows; None: nothing is
    later, and inserts may follow the last row."""
    last, after, n = after is None, after or GOAL, len(codes)
    low = estimates(codes, after)
    systems = [False] * (n + 1)  # whether a system row that may stay is to come
    for i in range(n - 1, -1, -1):
        systems[i] = systems[i + 1] or codes[i] & 7 == 0

    def left(i: int, state: int) -> int:
        if state == USER:
            return low[i][1]
        return max(0, low[i][0] - REROLE) if state == START and systems[i] else low[i][0]

    failed = [-1] * (4 * (n + 1))  # largest budget that a node has failed with
    bound = left(0, begin)
    while True:
        path: list[str] = []
        stack = [[0, begin, 0, 0]]  # rows read, state, cost so far, edits tried
        while stack:
            node = stack[-1]
            i, state, cost, tried = node
            if i == n and tried == 0:
                if (state in (START, ASSISTANT) and cost <= bound) if last else cost + after[state] <= bound:
                    return "".join(path), state, cost
            if i == n and not last or tried == 4:
                k = 4 * i + state
                failed[k] = max(failed[k], bound - cost)
                stack.pop()
                if path:
                    path.pop()
                continue
            node[3] = tried + 1
            edit = "DIKR"[tried]
            if i == n and edit != "I":
                continue
            taken = step(codes[i] if i < n else 0, state, edit)
            if taken is None:
                continue
            j, then, new = i + (edit != "I"), taken[1], cost + taken[0]
            if new + left(j, then) <= bound and bound - new > failed[4 * j + then]:
                stack.append([j, then, new, 0])
                path.append(edit)
        bound += 1


def applied(audit: str, begin: int, rows: list) -> Iterator[tuple[str, int | None, str, str]]:
    """(edit, turn, role, text) of the turns that the edits leave, from rows
    (turn, role, text)."""
    i, state = 0, begin
    for edit in audit:
        if edit == "I":
            state = DUE[state]
            yield edit, None, NAMES[state], ""
            continue
        row, i = rows[i], i + 1
        if edit == "R":
            state = DUE[state]
            yield edit, row["turn"], NAMES[state], row["text"]
        elif edit == "K":
            state = SYSTEM if row["role"][:1] == "s" else DUE[state]
            yield edit, row["turn"], row["role"], row["text"]


# --- the table ---------------------------------------------------------------

COUNTS = "blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, low_turn long, high_turn long, turns long, first_turn long, last_turn long"


def _summary(rows: list[tuple], codes: list[tuple[int, str]]) -> tuple:
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    turns = [t for t, _, _ in rows if t is not None]
    faults = [f for _, f in codes]
    ends = (turns[0], turns[-1]) if turns else (None, None)
    return (
        *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, initials[0], initials[-1],
        ends[0], ends[1], len(set(turns)), rows[0][0], rows[-1][0],
    )


def segments(conversations: DataFrame, most_rows: int = SEGMENT_ROWS, most_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Stored: one row per segment with its rows, their codes, its counts and,
    where it is no whole conversation, its costs. ``seg`` ascends along each
    conversation."""
    space = F.lit(" ")
    rows = numbered(conversations, "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    own = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")), F.length("role").cast("string"), F.concat("role", "text"))
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"), F.col("rid").alias("rid"))
    narrow = store(rows.select("rid", F.sha2(own, 256).alias("key"), place.alias("place")), "places")
    later = with_group(narrow, "key", [F.min("place").alias("first")]).filter("place <> first").select("rid", F.lit(True).alias("duplicate"))
    later = store(later, "duplicates")
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("conv_id", "turn", "rid")
    dealt = join_small(rows, later, "rid", "left").repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(it):
        n, held, codes, chars, at, whole, part = 0, [], [], 0, (), False, 0

        def segment(whole: bool) -> tuple:
            data = bytes(c for c, _ in codes)
            matrix = [] if whole else [x for row in costs(data) for x in row]
            made = [{"turn": t, "role": r, "text": x} for t, r, x in held]
            return (at[0], part << 32 | n, whole, data, matrix, made, *_summary(held, codes))

        for part, conv, turn, role, text, duplicate in it:  # noqa: B007  part stays for the last segment
            new = at != (conv,)
            if held and (new or len(held) >= most_rows or chars >= most_chars):
                yield segment(whole and new)
                n, held, codes, chars = n + 1, [], [], 0
                whole = new
            at = (conv,)
            held.append((turn, role, text))
            codes.append(code_of(role, text, bool(duplicate)))
            chars += len(text)
        if held:  # the conversation may go on in the next part
            yield segment(False)

    row = "struct<turn: long, role: string, text: string>"
    schema = f"conv_id long, seg long, whole boolean, codes binary, costs array<long>, rows array<{row}>, {COUNTS}"
    out = store(map_rows(dealt.select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "turn", "role", "text", "duplicate"), run, schema), "segments")
    drop(narrow, later)
    return out


def _streamed(df: DataFrame, *order: Column | str) -> DataFrame:
    """Rows of a conversation together and in order, to be read one by one."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def plans(segs: DataFrame) -> DataFrame:
    """Stored (conv_id, seg, begin, audit, cost): each segment's edits."""
    parted = segs.filter("not whole").select("conv_id", "seg", "costs")

    def behind(it):
        at, after = None, GOAL
        for conv, seg, flat in it:
            last = at != (conv,)
            if last:
                at, after = (conv,), GOAL
            yield conv, seg, last, after
            after = through([flat[4 * k : 4 * k + 4] for k in range(4)], after)

    ends = store(map_rows(_streamed(parted, F.desc("seg")), behind, "conv_id long, seg long, last boolean, after array<long>"), "ends")

    def searched(it):
        for conv, seg, codes, whole, last, after in it:
            begins = (START,) if whole else range(4)
            found = [search(codes, b, None if whole or last else after) for b in begins]
            yield conv, seg, whole, [{"audit": a, "state": s, "cost": c} for a, s, c in found]

    found = "array<struct<audit: string, state: int, cost: long>>"
    tasks = segs.select("conv_id", "seg", "codes", "whole").join(ends.drop("conv_id"), "seg", "left").select("conv_id", "seg", "codes", "whole", "last", "after")
    tried = store(map_rows(tasks, searched, f"conv_id long, seg long, whole boolean, found {found}"), "searched")

    def ahead(it):
        at, state = None, START
        for conv, seg, by_state in it:
            if at != (conv,):
                at, state = (conv,), START
            chosen = by_state[state]
            yield conv, seg, state, chosen["audit"], chosen["cost"]
            state = chosen["state"]

    chained = map_rows(_streamed(tried.filter("not whole").select("conv_id", "seg", "found"), "seg"), ahead, "conv_id long, seg long, begin int, audit string, cost long")
    one = tried.filter("whole").select("conv_id", "seg", F.lit(START).alias("begin"), F.col("found")[0]["audit"].alias("audit"), F.col("found")[0]["cost"].alias("cost"))
    out = store(one.unionByName(chained), "plans")
    drop(ends, tried)
    return out


def repaired(segs: DataFrame, plan: DataFrame) -> DataFrame:
    """The turns after repair: conv_id, seg, place (order in the segment),
    edit, turn (null if inserted), role, text."""

    def run(it):
        for conv, seg, rows, begin, audit in it:
            for place, turn in enumerate(applied(audit, begin, rows)):
                yield conv, seg, place, *turn

    both = segs.select("conv_id", "seg", "rows").join(plan.select("seg", "begin", "audit"), "seg")
    return map_rows(both.select("conv_id", "seg", "rows", "begin", "audit"), run, "conv_id long, seg long, place long, edit string, turn long, role string, text string")


def reports(segs: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit. Streams a conversation's segments' counts."""
    names = [c.strip().split(" ")[0] for c in COUNTS.split(",")]

    def run(it):
        at = None
        for conv, _, cost, audit, blank, duplicate, truncated, illegal, first, last, low, high, turns, begin, end in it:
            if at != (conv,):
                if at:
                    yield *at, *closed(held, audits)
                at, audits = (conv,), [audit]
                held = [blank, duplicate, truncated, illegal, cost, low, high, turns, last, end]
                continue
            seam = held[8] + first not in LEGAL
            same = begin is not None and begin == held[9]
            held[:5] = [held[0] + blank, held[1] + duplicate, held[2] + truncated, held[3] + illegal + seam, held[4] + cost]
            held[5] = low if held[5] is None else held[5]
            held[6] = held[6] if high is None else high
            held[7:] = [held[7] + turns - same, last, end]
            audits.append(audit)
        if at:
            yield *at, *closed(held, audits)

    def closed(held: list, audits: list[str]) -> tuple:
        blank, duplicate, truncated, illegal, cost, low, high, turns = held[:8]
        return 0 if low is None else high - low + 1 - turns, blank, duplicate, truncated, illegal, cost, "".join(audits)

    counted = segs.select("seg", *names).join(plan, "seg").select("conv_id", "seg", "cost", "audit", *names)
    return map_rows(_streamed(counted, "seg"), run, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of each conversation's ``role:text`` lines, read one
    by one: a digest has to see its lines in order, but none are held."""

    def run(it):
        at, sha = None, None
        for conv, _, _, role, text in it:
            if at != (conv,):
                if at:
                    yield *at, sha.hexdigest()
                at, sha = (conv,), hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        if at:
            yield *at, sha.hexdigest()

    return map_rows(_streamed(turns.select("conv_id", "seg", "place", "role", "text"), "seg", "place"), run, "conv_id long, sha256 string")
