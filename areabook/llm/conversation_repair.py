"""Conversation structure repair by weighted CYK interval parsing.

A conversation is a sequence of rows; a well-formed one has the role initials
(s?(ua)+)?. The repair grammar is in Chomsky normal form. Its nonterminals are pairs of
states [p,q] ("this span takes the dialogue from p to q"), its rules [p,q] -> [p,r] [r,q], and
its terminals the weighted edits of one row: Keep, Rerole, Delete. Inserted rows are the
closure: [p,q] also derives the empty span at the cost of the shortest chain of Inserts, and a
terminal's cell is closed on both sides. A cell holds the minimum (cost, audit), audit being the
edits' initials. Edits that cost the same are never prefixes of one another (a longer audit over
the same rows has more Inserts, which cost), so minima of two spans joined are the minimum of
the joined span, and joining is associative: each span needs one split point, and a chart of
spans of 1, 2, 4, ... rows, built bottom-up by span length, is exact in O(n) cells.

On Spark: equal rows of a conversation are counted before anything is sorted; rows are then
range-partitioned by (conversation, turn, role, text), so a conversation with a third of all
rows lies in many tasks. A task parses the runs that end inside it at once; runs that touch its
border, and runs of more than `CHUNK` rows, leave as spans of at most `CHUNK` rows. Spans meet by
conversation, where only their codes (a byte a row) travel: the chart goes on over them, and the
states chosen at the span borders go back to the spans, whose repaired lines are hashed in order
(a running SHA-256, one span in memory at a time).

Order: turn (NULLs first), then role, then text. Faults, first one counts: blank (no character but
ASCII white space), duplicate (role and text seen earlier in the conversation), truncated (last
such character not one of . ! ?). Blank and duplicate rows must be deleted.

Edge cases: NULL role or text is one space; a NULL conversation id is an ordinary id and a NULL
turn sorts first; repeated rows and equal turns are ordinary rows (all but the first of
equal ones are duplicates); roles with other initials can be reroled or deleted only; an empty
table gives an empty result; other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areabook.llm.common import left_join, stager

#: Rows a span holds at most.
CHUNK = 1024
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
LEGAL_PAIRS = ("su", "ua", "au")
#: States of the dialogue: nothing said, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
FINAL = (START, ASSISTANT)
MOVES = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NAMES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

Cells = dict[tuple[int, int], tuple[int, str]]


def _least(cells: Cells, key: tuple[int, int], value: tuple[int, str]) -> None:
    if key not in cells or value < cells[key]:
        cells[key] = value


def join(left: Cells, right: Cells) -> Cells:
    """[p,q] -> [p,r] [r,q]: the cells of two spans that lie side by side."""
    out: Cells = {}
    for (p, r), (c1, a1) in left.items():
        for (r2, q), (c2, a2) in right.items():
            if r == r2:
                _least(out, (p, q), (c1 + c2, a1 + a2))
    return out


def _insertions() -> Cells:
    """The empty span: each pair of states at the cost of its shortest chain of Inserts."""
    cells: Cells = {(p, p): (0, "") for p in STATES}
    for _ in STATES:
        for (p, r), (c, a) in list(cells.items()):
            for s in NAMES:
                if r in MOVES[s]:
                    _least(cells, (p, MOVES[s][r]), (c + INSERT, a + "I"))
    return cells


CLOSURE = _insertions()


@lru_cache(maxsize=64)
def terminal(code: str) -> Cells:
    """The closed cells of one row. Its code: d for a row that must go, else its role's initial
    (x for others), as a capital if the row is truncated."""
    edits: Cells = {(p, p): (DELETE, "D") for p in STATES}
    if code != "d":
        extra = TRUNCATED if code.isupper() else 0
        for s, moves in MOVES.items():
            for p, q in moves.items():
                if s == code.lower():
                    _least(edits, (p, q), (extra, "K"))
                elif s in NAMES:
                    _least(edits, (p, q), (extra + REROLE, "R"))
    return join(join(CLOSURE, edits), CLOSURE)


def chart(cells: list[Cells]) -> Cells:
    """Bottom-up by span length: neighbours join until one span is left."""
    while len(cells) > 1:
        odd = cells[-1:] if len(cells) % 2 else []
        cells = [join(a, b) for a, b in zip(cells[::2], cells[1::2])] + odd
    return cells[0] if cells else CLOSURE


@lru_cache(maxsize=8192)
def _parsed(codes: str) -> Cells:
    return chart([terminal(c) for c in codes])


def parse(codes: str) -> Cells:
    """Cells of a span of rows given by their codes (short spans recur and are remembered)."""
    return _parsed(codes) if len(codes) <= 64 else chart([_parsed(codes[i:i + 64]) for i in range(0, len(codes), 64)])


def best(cells: Cells, start: int = START) -> tuple[int, str, int]:
    """(cost, audit, last state) of the cheapest well-formed reading."""
    return min((*cells[start, q], q) for q in FINAL if (start, q) in cells)


def apply(codes: str, audit: str, state: int, lines: list) -> Iterator[str]:
    """Repaired "role:text" lines of a span; `lines` holds (role, text) of its rows but those of code d."""
    rows, kept = iter(codes), iter(lines)
    for edit in audit:
        code = "" if edit == "I" else next(rows)
        role, text = next(kept) if edit != "I" and code != "d" else ("", "")
        if edit == "D":
            continue
        symbol = code.lower() if edit == "K" else "a" if state == USER else "u"
        yield f"{role if edit == 'K' else NAMES[symbol]}:{text}"
        state = MOVES[symbol][state]


# ---- the rows, their faults and their order ---------------------------------------------------

def coded(rows: DataFrame) -> DataFrame:
    """Distinct rows with their count: (conv_id, turn, role, text, n, initial, code, fault)."""
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n")).withColumn("print", F.sha2("text", 256))
    seen = counted.groupBy("conv_id", "role", "print").agg(F.min(F.struct("turn"))["turn"].alias("first_turn"))
    met = left_join(counted, seen, ["conv_id", "role", "print"])
    said = F.rtrim(F.col("text"), F.lit(BLANKS))
    blank, again = F.length(said) == 0, ~F.col("turn").eqNullSafe(F.col("first_turn"))
    truncated = ~F.right(said, F.lit(1)).isin(*ENDS)
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin(*MOVES), initial).otherwise("x")
    return met.select(
        "conv_id", "turn", "role", "text", "n", initial.alias("initial"),
        F.when(blank, "b").when(again, "d").when(truncated, "t").alias("fault"),
        F.when(blank | again, "d").when(truncated, F.upper(known)).otherwise(known).alias("code"))


#: Counts of a run of rows; pairs and turns across a border are settled where two runs meet.
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_RUN = ([("conv_id", None), ("part", pa.int32()), ("chunk", pa.int32()), ("codes", pa.string())]
        + [(c, pa.int64()) for c in _COUNTS] + [("first_turn", None), ("last_turn", None), ("first_initial", pa.string()),
                                                ("last_initial", pa.string())])


class _Run:
    """Rows of one conversation that follow each other in the order."""

    def __init__(self):
        self.codes, self.lines, self.size = [], [], 0
        self.count = dict.fromkeys(_COUNTS, 0)
        self.turn = self.first_turn = self.last_initial = self.first_initial = None

    def add(self, turn, role, text, n, initial, fault, code) -> None:
        if self.size:
            self.count["illegal"] += self.last_initial + initial not in LEGAL_PAIRS
        else:
            self.first_initial = initial
        self.last_initial = initial
        self.count["illegal"] += n - 1                       # a pair of equal roles is never legal
        if turn is not None and turn != self.turn:
            self.count["turns"] += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turn = turn
        self.count["blank"] += n if fault == "b" else 0
        self.count["duplicate"] += n if fault == "d" else 0 if fault == "b" else n - 1
        self.count["truncated"] += fault == "t"
        self.codes.append(code + "d" * (n - 1))
        if code != "d":
            self.lines.append((role, text))
        self.size += 1

    def follow(self, o: dict) -> None:
        """The counts of a later span of the same conversation."""
        if self.size:
            self.count["illegal"] += self.last_initial + o["first_initial"] not in LEGAL_PAIRS
            self.count["turns"] -= o["first_turn"] is not None and o["first_turn"] == self.turn
        for c in _COUNTS:
            self.count[c] += o[c]
        self.first_turn = o["first_turn"] if self.first_turn is None else self.first_turn
        self.turn = self.turn if o["last_turn"] is None else o["last_turn"]
        self.last_initial = o["last_initial"]
        self.size += 1

    def facts(self) -> dict:
        gaps = 0 if self.first_turn is None else self.turn - self.first_turn + 1 - self.count["turns"]
        return {"gaps": gaps, **{c: self.count[c] for c in _COUNTS if c != "turns"}}


#: What a repaired conversation is reported by.
FACTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _sha(lines) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def _runs(batches: Iterator[pa.RecordBatch], schema: pa.Schema, chunk: int) -> Iterator[pa.RecordBatch]:
    """One partition of the order: a finished conversation or a span a row."""
    run, conv, part, number, first, out = None, None, 0, 0, True, []

    def span():
        return {"conv_id": conv, "part": part, "chunk": number, "codes": "".join(run.codes), **run.count,
                "first_turn": run.first_turn, "last_turn": run.turn, "first_initial": run.first_initial,
                "last_initial": run.last_initial, "lines": [{"role": r, "text": t} for r, t in run.lines], "done": False}

    def finished():
        codes = "".join(run.codes)
        cost, audit, _ = best(parse(codes))
        return {"conv_id": conv, **run.facts(), "cost": cost, "audit": audit,
                "repaired_sha256": _sha(apply(codes, audit, START, run.lines)), "done": True}

    for batch in batches:
        for row in batch.to_pylist():
            if run is None or row["conv_id"] != conv:
                if run is not None:
                    out.append(span() if first or number else finished())
                    first = False
                run, conv, part, number = _Run(), row["conv_id"], row["part"], 0
            elif run.size >= chunk:
                out.append(span())
                run, number = _Run(), number + 1
            run.add(*[row[k] for k in ("turn", "role", "text", "n", "initial", "fault", "code")])
        if len(out) >= 256 or out and sum(len(t["text"]) for o in out if not o["done"] for t in o["lines"]) > 1 << 20:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if run is not None:
        out.append(span())
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


class _Spans:
    """The chart over a conversation's spans, in their order: neighbours of one size join at once. Which
    state lies between the two is kept, so the states at all borders can be read back."""

    def __init__(self):
        self.pending, self.places = [], []

    def add(self, place, codes: str) -> None:
        self.places.append(place)
        self.pending.append((1, parse(codes), None))
        while len(self.pending) > 1 and self.pending[-2][0] == self.pending[-1][0]:
            self._join()

    def _join(self) -> None:
        (n1, left, t1), (n2, right, t2) = self.pending[-2:]
        cells = join(left, right)
        mid = {(p, q): min((left[p, r][0] + right[r, q][0], left[p, r][1] + right[r, q][1], r)
                           for r in STATES if (p, r) in left and (r, q) in right)[2] for p, q in cells}
        self.pending[-2:] = [(n1 + n2, cells, (t1, t2, mid))]

    def close(self) -> tuple[int, str, list]:
        """(cost, audit, [(place, state before, state after)])."""
        while len(self.pending) > 1:
            self._join()
        _, cells, tree = self.pending[0]
        cost, audit, last = best(cells)
        borders, todo = [], [(tree, START, last)]
        while todo:
            tree, p, q = todo.pop()
            if tree is None:
                borders.append((p, q))
            else:
                left, right, mid = tree
                todo += [(right, mid[p, q], q), (left, p, mid[p, q])]
        return cost, audit, [(place, p, q) for place, (p, q) in zip(self.places, borders)]


def _borders(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Spans by conversation and place -> the conversation's facts, and the states around each span."""
    conv, spans, run, out = None, None, None, []

    def close():
        cost, audit, borders = spans.close()
        rows = [{"conv_id": conv, "done": True, **run.facts(), "cost": cost, "audit": audit}]
        return rows + [{"conv_id": conv, "done": False, "part": p, "chunk": c, "before": b, "after": a}
                       for (p, c), b, a in borders]

    for batch in batches:
        for row in batch.to_pylist():
            if spans is None or row["conv_id"] != conv:
                out += close() if spans else []
                conv, spans, run = row["conv_id"], _Spans(), _Run()
            spans.add((row["part"], row["chunk"]), row["codes"])
            run.follow(row)
        if len(out) >= 4096:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    out += close() if spans else []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _hashes(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Spans with their lines and states, by conversation and place -> SHA-256 of the repaired conversation."""
    conv, digest, empty, out = None, None, True, []
    for batch in batches:
        for row in batch.to_pylist():
            if digest is None or row["conv_id"] != conv:
                if digest is not None:
                    out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                conv, digest, empty = row["conv_id"], hashlib.sha256(), True
            audit = parse(row["codes"])[row["before"], row["after"]][1]
            for line in apply(row["codes"], audit, row["before"], [(x["role"], x["text"]) for x in row["lines"]]):
                digest.update(("" if empty else "\n").encode() + line.encode("utf-8", "surrogatepass"))
                empty = False
    if digest is not None:
        out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _mapped(df: DataFrame, fn, fields: list[tuple[str, str]], *args) -> DataFrame:
    """mapInArrow with a schema of (name, SQL type)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    types = StructType.fromDDL(", ".join(f"{n} {t}" for n, t in fields))
    schema = to_arrow_schema(types)
    return df.mapInArrow(lambda batches: fn(batches, schema, *args), types)


def repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every
    conversation of rows(conv_id, turn, role, text); conv_id and turn are integers."""
    st = stager(rows.sparkSession, "repair")
    kinds = dict(rows.dtypes)
    conv, turn = ("conv_id", kinds["conv_id"]), kinds["turn"]
    order = ["conv_id", "turn", "role", "text"]
    ordered = (st.stage(coded(rows), "coded").repartitionByRange(*order).withColumn("part", F.spark_partition_id())
               .sortWithinPartitions(*order))
    span = [("part", "int"), ("chunk", "int"), ("codes", "string"), *[(c, "long") for c in ("turns",)],
            ("first_turn", turn), ("last_turn", turn), ("first_initial", "string"), ("last_initial", "string"),
            ("lines", "array<struct<role: string, text: string>>")]
    facts = [(c, "long") for c in FACTS] + [("audit", "string")]
    runs = st.stage(_mapped(ordered, _runs, [conv, ("done", "boolean"), *facts, ("repaired_sha256", "string"), *span], chunk), "runs")
    spans = runs.filter("not done")
    place = ["conv_id", "part", "chunk"]
    met = (spans.select(*place, "codes", *_COUNTS, "first_turn", "last_turn", "first_initial", "last_initial")
           .repartition("conv_id").sortWithinPartitions(*place))
    states = st.stage(_mapped(met, _borders, [conv, ("done", "boolean"), *facts, ("part", "int"), ("chunk", "int"),
                                              ("before", "int"), ("after", "int")]), "states")
    lines = left_join(spans.select(*place, "codes", "lines"), states.filter("not done").select(*place, "before", "after"), place)
    hashes = _mapped(lines.repartition("conv_id").sortWithinPartitions(*place), _hashes, [conv, ("repaired_sha256", "string")])
    cut = left_join(states.filter("done").select("conv_id", *[c for c, _ in facts]), hashes, ["conv_id"])
    return runs.filter("done").select(*cut.columns).unionByName(cut)


def damage(rows: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text) with the faults that test a repair, chosen by crc32 of "conv_id:turn" (NULLs are
    one space) modulo 20: 0 drops the row, 1 empties its text, 2 removes its . ! ?, 3 repeats it, 4 makes it the user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate: Column = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fate.alias("fate"))
            .filter("fate <> 0")
            .select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(copies).alias("copy")).drop("copy"))
