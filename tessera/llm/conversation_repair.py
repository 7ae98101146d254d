"""Conversation structure repair: cheapest edits by grammar-compressed dynamic programming.

A conversation should have the roles ``(s?(ua)+)?`` (initials of system, user and
assistant).  Each of its rows carries a role class and a first fault: blank (no
character beyond white space), duplicate (role and text seen earlier in the
conversation) or truncated (its last such character ends no sentence).  Edits:
keep a row (K, 0), give it another role (R, 3), delete it (D, 4; required for
blank and duplicate rows), insert an empty user or assistant row anywhere (I, 3);
a truncated row that stays adds 3.  Of the cheapest edit strings the least one
is taken; it fixes the repaired rows, since every edit's role follows from the
roles before it.

1. Rows become symbols (role class and fault), sixteen in all, computed by
   DataFrame functions; equal rows of one turn are one row with a count, and
   which is the first of equal ones comes from a grouped minimum, so no text is
   shuffled for it.
2. A range sort by conversation and turn deals the rows to tasks; each task
   writes its conversations as symbol strings, a long conversation as several
   segments of at most ``SEGMENT`` symbols that may lie in different tasks.
3. Different strings are dealt to groups.  A group compresses its strings
   together by Re-Pair (the most frequent pair of symbols becomes a rule).  Each
   terminal has a min-plus transfer matrix over the four states of the role
   pattern; a rule's matrix is the product of its two symbols', once for
   all conversations that use it.  Next to the cost a matrix holds the order of
   its audit strings and, as a rope, the two entries that make up the best one, so
   products compare numbers, and only the strings asked for are spelled out.
   (All audits of one string of rows spell the same number of row edits, so none
   begins another, and comparing concatenations part by part is exact.)
4. A last pass streams every conversation's segments, then its rows, through one
   task in order: the segments' matrices are multiplied from the start state, and
   the rows are hashed under the audit as they come.  The hash of a text is
   sequential; the state is one digest and the audit, never the rows.

Cases: a null conv_id is a conversation of its own; null roles and texts count as one
space; null turns come first; rows of one turn stand by role, then text hash, equal rows
side by side; a conversation whose rows have all gone has zeros, an empty audit and the
hash of the empty text; an empty table gives an empty result; other columns are ignored.
Equal texts are found by 64-bit hashes.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.tables import written

SEGMENT = 1 << 16  # symbols of one string
GROUP_SYMBOLS = 1 << 17  # symbols that share a grammar
WHITE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3

CLASSES = "sua?"  # role initials; ? stands for any other
FAULTS = ("ok", "truncated", "blank", "duplicate")
SYMBOLS = "abcdefghijklmnop"  # SYMBOLS[4 * class + fault]
#: States of the role pattern: nothing yet, after s, after u, after a; the first and the last accept.
STATES = 4
_NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
_ACCEPT = (0, 3)
_INF = 1 << 60


# --- matrices -------------------------------------------------------------------------------------------------------
# A matrix is a list of 16 entries (cost, order, rope); entry 4 * s + t leads from state s to state t.  The order numbers
# the different audits of the matrix from the least.  A rope is a string, or (left matrix, entry, right matrix, entry).

def _ranked(best: dict[int, tuple]) -> list:
    """Matrix from the best (cost, sort key, rope) of each reachable entry."""
    order = {k: i for i, k in enumerate(sorted({b[1] for b in best.values()}))}
    out: list = [None] * (STATES * STATES)
    for e, (cost, key, rope) in best.items():
        out[e] = (cost, order[key], rope)
    return out


def product(a: list, b: list) -> list:
    """Min-plus product; ties go to the least audit."""
    best: dict[int, tuple] = {}
    for s in range(STATES):
        for k in range(STATES):
            x = a[STATES * s + k]
            if x is None:
                continue
            for t in range(STATES):
                y = b[STATES * k + t]
                if y is None:
                    continue
                e, cost, key = STATES * s + t, x[0] + y[0], (x[1], y[1])
                if e not in best or (cost, key) < best[e][:2]:
                    best[e] = (cost, key, (a, STATES * s + k, b, STATES * k + t))
    return _ranked(best)


def _closed(step: dict[tuple[int, int], tuple[int, str]]) -> list:
    """Matrix of a step behind any number of insertions."""
    best: dict[int, tuple] = {}
    for s in range(STATES):
        reach, states = [(0, "", s)], {s: 0}
        while reach:  # a state is worth entering once: later visits cost more
            cost, audit, k = reach.pop(0)
            for (a, b), (c, letter) in step.items():
                if a == k:
                    e, new = STATES * s + b, (cost + c, audit + letter, audit + letter)
                    if e not in best or new[:2] < best[e][:2]:
                        best[e] = new
            for role in "ua":
                to = _NEXT.get((role, k))
                if to is not None and to not in states:
                    states[to] = cost + INSERT
                    reach.append((cost + INSERT, audit + "I", to))
    return _ranked(best)


def terminal(symbol: str) -> list:
    """Matrix of one row: insertions before it, then its own edit."""
    at = SYMBOLS.index(symbol)
    role, fault = CLASSES[at // 4], FAULTS[at % 4]
    step: dict[tuple[int, int], tuple[int, str]] = {(s, s): (DELETE, "D") for s in range(STATES)}
    if fault in ("ok", "truncated"):
        more = TRUNCATED if fault == "truncated" else 0
        for (r, s), t in _NEXT.items():
            if r in "ua" and (s, t) not in step:
                step[s, t] = (REROLE + more, "R")
        for (r, s), t in _NEXT.items():
            if r == role:
                step[s, t] = (KEEP + more, "K")
    return _closed(step)


#: Behind the last row: insertions only.
END = _closed({(s, s): (0, "") for s in range(STATES)})
#: No row at all.
UNIT = _ranked({STATES * s + s: (0, "", "") for s in range(STATES)})


def spelled(matrix: list, entry: int) -> str:
    """The audit of one entry."""
    out, open_ = [], [matrix[entry][2]]
    while open_:
        rope = open_.pop()
        if isinstance(rope, str):
            out.append(rope)
        else:
            a, i, b, j = rope
            open_.append(b[j][2])
            open_.append(a[i][2])
    return "".join(out)


# --- grammar --------------------------------------------------------------------------------------------------------

def re_pair(strings: list[np.ndarray], terminals: int) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """Re-Pair over all strings together: (compressed strings, rules); rule r is symbol ``terminals + r``.

    The most frequent pairs without a common symbol are replaced in the same round; a pair of equal symbols is replaced
    from the left.  Ends when no pair occurs twice.
    """
    ends = np.cumsum([len(s) + 1 for s in strings], dtype=np.int64)
    text = np.full(int(ends[-1]) if len(ends) else 0, -1, np.int64)
    for s, e in zip(strings, ends.tolist(), strict=True):
        text[e - 1 - len(s):e - 1] = s
    rules: list[tuple[int, int]] = []
    while len(text) > 1:
        base = terminals + len(rules)
        inner = np.flatnonzero((text[:-1] >= 0) & (text[1:] >= 0))
        key = text[inner] * base + text[inner + 1]
        # of a run of equal symbols every second place counts
        equal = text[inner] == text[inner + 1]
        fresh = np.append(True, (np.diff(inner) > 1) | (np.diff(key) != 0)) if len(inner) else np.zeros(0, bool)
        start = inner[fresh][np.cumsum(fresh) - 1]
        good = ~equal | ((inner - start) % 2 == 0)
        inner, key = inner[good], key[good]
        pairs, count = np.unique(key, return_counts=True)
        many = np.flatnonzero(count > 1)
        if not len(many):
            break
        many = many[np.lexsort((pairs[many], -count[many]))]
        used: set[int] = set()
        chosen: dict[int, int] = {}
        least = max(2, int(count[many[0]]) // 2)  # rarer pairs wait: the replaced ones change their counts
        for at in many:
            if count[at] < least:
                break
            a, b = divmod(int(pairs[at]), base)
            if a in used or b in used:
                continue
            used |= {a, b}
            chosen[int(pairs[at])] = terminals + len(rules)
            rules.append((a, b))
        wanted = np.array(sorted(chosen))
        hit = wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key
        where, to = inner[hit], np.array([chosen[k] for k in wanted.tolist()])[np.searchsorted(wanted, key[hit])]
        text[where] = to
        text = np.delete(text, where + 1)
    out = np.split(text, np.flatnonzero(text < 0) + 1)[:-1] if len(text) else []
    return [s[:-1] for s in out], rules


def matrices(strings: list[str]) -> list[list]:
    """The transfer matrix of each symbol string, through one grammar for all of them."""
    coded = [np.frombuffer(s.encode(), np.uint8).astype(np.int64) - ord(SYMBOLS[0]) for s in strings]
    compressed, rules = re_pair(coded, len(SYMBOLS))
    of = [terminal(c) for c in SYMBOLS]
    for a, b in rules:  # bottom-up: a rule's symbols come before it
        of.append(product(of[a], of[b]))
    out = []
    for s in compressed:
        m = UNIT
        for symbol in s.tolist():
            m = of[symbol] if m is UNIT else product(m, of[symbol])
        out.append(m)
    return out


def _evaluate(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    strings = group["symbols"].tolist()
    costs, orders, audits = [], [], []
    for m in matrices(strings):
        costs.append([-1 if x is None else x[0] for x in m])
        orders.append([-1 if x is None else x[1] for x in m])
        spelt = {x[1]: spelled(m, e) for e, x in enumerate(m) if x is not None}
        audits.append([spelt[o] for o in range(len(spelt))])
    return pd.DataFrame({"symbols": strings, "costs": costs, "orders": orders, "audits": audits})


# --- rows and symbols -----------------------------------------------------------------------------------------------

def _order() -> list[Column]:
    """Rows of a conversation in order (null turns first)."""
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("key").asc()]


def rows_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None) -> DataFrame:
    """conv, turn, role, text, n (how often the row stands there; 0: gone, the conversation stays), key (hash of role and text)."""
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit(" ")), F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    n = F.lit(1) if copies is None else copies
    return conversations.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), n.cast("long").alias("n")).withColumn("key", F.xxhash64("role", "text"))


def _symbol_rows(rows: DataFrame) -> DataFrame:
    """conv, turn, role, key, n, class, fault of the first copy (0, 1 or 2) and ``seen``: whether an equal row stands earlier."""
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(end == "", 2).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    each = rows.withColumn("class", kind).withColumn("fault", fault).groupBy("conv", "turn", "role", "key").agg(F.sum("n").alias("n"), F.min("class").alias("class"), F.min("fault").alias("fault"))
    each = written(each, "conversation-rows")
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    first = each.where("n > 0").groupBy("conv", "key", "role").agg(F.min(place).alias("first"), F.count("*").alias("places")).where("places > 1").select(F.col("conv").alias("c"), F.col("key").alias("k"), F.col("role").alias("r"), "first")
    joined = each.join(written(first, "conversation-repeats"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")) & (F.col("role") == F.col("r")), "left")
    return joined.select("conv", "turn", "role", "key", "n", "class", "fault", F.coalesce(F.col("first") < place, F.lit(False)).alias("seen"))


_SEGMENT_SCHEMA = "conv long, segment long, symbols string, first_turn long, last_turn long, turns long"


def _segments(size: int):
    def emit(batches):
        base, made = TaskContext.get().partitionId() << 33, 0
        conv, held, count, turns = (), [], 0, []
        out: list[tuple] = []

        def close():
            nonlocal made, held, count, turns
            known = [t for t in turns if t is not None]
            out.append((conv[0], base + made, "".join(held), known[0] if known else None, known[-1] if known else None, len(set(known))))
            made, held, count, turns = made + 1, [], 0, []

        for batch in batches:
            for c, turn, n, kind, fault, seen in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if conv and conv[0] != c:
                    close()
                conv = (c,)
                while n:
                    symbols = SYMBOLS[4 * kind + (fault if fault == 2 else 3 if seen else fault)]
                    if count >= size:
                        close()
                    take = 1 if not seen else min(n, size - count)
                    held.append(symbols * take)
                    if not turns or turns[-1] != turn:
                        turns.append(turn)
                    count, n, seen = count + take, n - take, True
            if len(out) > 4096:
                yield _records(out)
                out = []
        if conv:
            close()
        yield _records(out)
    return emit


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["conv", "segment", "symbols", "first_turn", "last_turn", "turns"])


def _string_matrices(segments: DataFrame, group_symbols: int) -> DataFrame:
    """symbols, costs, orders, audits of every different symbol string."""
    strings = written(segments.select("symbols").distinct(), "symbol-strings")
    total = strings.agg(F.sum(F.length("symbols"))).first()[0] or 0
    groups = max(1, -(-int(total) // group_symbols))
    dealt = strings.withColumn("grp", F.pmod(F.xxhash64("symbols"), F.lit(groups)))
    return dealt.groupBy("grp").applyInPandas(_evaluate, "symbols string, costs array<long>, orders array<int>, audits array<string>")


# --- the last pass --------------------------------------------------------------------------------------------------

class _Conversation:
    """What the last pass holds of one conversation: the states' best audits, then the digest of its repaired rows."""

    def __init__(self, conv):
        self.conv = conv
        self.states = {0: (0, 0, ())}  # state -> (cost, order, rope of pieces)
        self.counts = [0, 0, 0]
        self.illegal = 0
        self.last = None
        self.turns, self.low, self.high = 0, None, None
        self.audit = None
        self.digest, self.lines = hashlib.sha256(), 0

    def _step(self, costs, orders, audits) -> None:
        best: dict[int, tuple] = {}
        for s, (cost, order, rope) in self.states.items():
            for t in range(STATES):
                c = costs[STATES * s + t]
                if c < 0:
                    continue
                o = orders[STATES * s + t]
                if t not in best or (cost + c, (order, o)) < best[t][:2]:
                    best[t] = (cost + c, (order, o), (rope, audits[o]))
        places = {k: i for i, k in enumerate(sorted({b[1] for b in best.values()}))}
        self.states = {t: (c, places[k], rope) for t, (c, k, rope) in best.items()}

    def add_segment(self, row) -> None:
        symbols = row["symbols"]
        if not symbols:
            return
        self._step(row["costs"], row["orders"], row["audits"])
        at = np.frombuffer(symbols.encode(), np.uint8).astype(np.int64) - ord(SYMBOLS[0])
        fault, kind = at % 4, at // 4
        for i, f in enumerate((2, 3, 1)):
            self.counts[i] += int((fault == f).sum())
        legal = ((kind[:-1] == 0) & (kind[1:] == 1)) | ((kind[:-1] == 1) & (kind[1:] == 2)) | ((kind[:-1] == 2) & (kind[1:] == 1))
        self.illegal += int((~legal).sum()) + (self.last is not None and (self.last, int(kind[0])) not in ((0, 1), (1, 2), (2, 1)))
        self.last = int(kind[-1])
        if row["first_turn"] is not None:
            self.turns += row["turns"] - (self.high == row["first_turn"])
            self.low = row["first_turn"] if self.low is None else self.low
            self.high = row["last_turn"]

    def settle(self) -> None:
        """All segments are in: choose the audit."""
        if self.last is None:
            self.cost, self.audit = 0, ""
        else:
            self._step([-1 if x is None else x[0] for x in END], [-1 if x is None else x[1] for x in END], {x[1]: x[2] for x in END if x is not None})
            self.cost, _, rope = min((self.states[t] for t in _ACCEPT if t in self.states), key=lambda b: b[:2])
            pieces = []
            while rope:
                rope, piece = rope
                pieces.append(piece)
            self.audit = "".join(reversed(pieces))
        self.at, self.state = 0, 0

    def _line(self, line: str) -> None:
        self.digest.update(("\n" if self.lines else "").encode() + line.encode())
        self.lines += 1

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._line(self._next_role() + ":")
            self.at += 1

    def _next_role(self) -> str:
        role, self.state = ("assistant", 3) if self.state == 2 else ("user", 2)
        return role

    def add_row(self, role: str, text: str, n: int) -> None:
        for _ in range(n):
            self._insertions()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.state = _NEXT[role[0], self.state]
                self._line(f"{role}:{text}")
            elif edit == "R":
                self._line(f"{self._next_role()}:{text}")

    def result(self) -> tuple:
        if self.audit is None:
            self.settle()
        self._insertions()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts, self.illegal, self.cost, self.audit, self.digest.hexdigest())


_RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _repair(batches):
    """Rows sorted by conversation, its segments in order first, then its rows in order."""
    now: _Conversation | None = None
    out: list[tuple] = []

    def records():
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=_RESULT)

    for batch in batches:
        names = batch.schema.names
        for values in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            row = dict(zip(names, values, strict=True))
            if now is None or now.conv != row["conv"]:
                if now is not None:
                    out.append(now.result())
                now = _Conversation(row["conv"])
            if row["segment"] is not None:
                now.add_segment(row)
            else:
                if now.audit is None:
                    now.settle()
                now.add_row(row["role"], row["text"], row["n"])
        if len(out) > 4096:
            yield records()
            out = []
    if now is not None:
        out.append(now.result())
    yield records()


def repair(rows: DataFrame, segment: int = SEGMENT, group_symbols: int = GROUP_SYMBOLS) -> DataFrame:
    """One row per conversation of ``rows_of``: gaps, faults, cost, audit of the edits and the digest of the repaired rows."""
    symbols = _symbol_rows(rows)
    dealt = symbols.repartitionByRange(*_order()).sortWithinPartitions(*_order()).select("conv", "turn", "n", "class", "fault", "seen")
    segments = written(dealt.mapInArrow(_segments(segment), _SEGMENT_SCHEMA), "conversation-segments")
    solved = written(_string_matrices(segments, group_symbols), "string-matrices")
    heads = segments.join(solved, "symbols").select("conv", "segment", "symbols", "first_turn", "last_turn", "turns", "costs", "orders", "audits")
    # equal rows of one turn needn't stand side by side as rows: they have one key, and the sort puts them together
    tails = rows.where("n > 0").select("conv", "turn", "role", "key", "text", "n")
    both = heads.unionByName(tails, allowMissingColumns=True)
    in_order = [F.col("conv").asc_nulls_first(), F.col("segment").asc_nulls_last(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("key").asc()]
    columns = ["conv", "segment", "symbols", "first_turn", "last_turn", "turns", "costs", "orders", "audits", "role", "text", "n"]
    return both.repartition("conv").sortWithinPartitions(*in_order).select(*columns).mapInArrow(_repair, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
