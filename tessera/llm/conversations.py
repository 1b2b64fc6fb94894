"""Repair of conversations: the cheapest edits that give legal turns, by depth-first branch and bound.

A conversation's rows become edits that keep, rename or delete each row and
put in empty turns, so that the roles' initials are ``(s?(ua)+)?``.  The search
goes down an explicit stack, edits in the order of their letters, so that
prefixes come in ASCII order.  It leaves a prefix whose cost and lower bound of
the rest exceed the incumbent's, and one that reaches a node (a row and a state
of the pattern) no cheaper than an earlier prefix has: equal costs come later
in order, so the earlier one is never worse.

Rows travel as one byte each.  A conversation of many rows is cut into
segments, searched between each two states and put together in rounds, so no
task holds it whole; texts only stream past, once, for the hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.runtime import cut

#: Rows of a segment, segments that are put together at once, and rows of the windows of lower bounds.
SEGMENT, TOGETHER, WINDOW = 256, 64, 4
#: Solved segments that a worker keeps.
KEPT = 50_000

#: States of the pattern: nothing yet, after s, after u, after a; and the state after each initial (none: not allowed).
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state after the one turn that may be put in.
NEXT = (USER, USER, ASSISTANT, USER)
ACCEPTED = (NOTHING, ASSISTANT)
LEGAL = ("su", "ua", "au")

#: A row's byte: its initial, and 4 for a truncated row, 8 for a blank or repeated one.
INITIALS = "sua"
TRUNCATED, REFUSED = 4, 8
FAR = 1 << 60

_windows: dict[bytes, int] = {}
_solved: dict[tuple, tuple[int, str] | None] = {}


def _edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """The edits of a row in ASCII order: letter, cost and state after it; ``I`` leaves the row for later."""
    found = [("D", 3, state), ("I", 2, NEXT[state])]
    if not code & REFUSED:
        extra = 1 if code & TRUNCATED else 0
        kind = code & 3
        kept = AFTER[state].get(INITIALS[kind]) if kind < 3 else None
        if kept is not None:
            found.append(("K", extra, kept))
        found.append(("R", 2 + extra, NEXT[state]))
    return found


_EDITS = {(code, state): _edits(code, state) for code in range(16) for state in range(4)}


def _window_cost(codes: bytes) -> int:
    """The least cost of a few rows between any two states."""
    found = _windows.get(codes)
    if found is None:
        solved = [_search(codes, entry, (0, 1, 2, 3), _suffix(codes, len(codes) - 1)) for entry in range(4)]
        found = _windows[codes] = min(s[0] for s in solved if s)
    return found


def _suffix(codes: bytes, widest: int) -> list[int]:
    """A lower bound of the cost of the rows from each on: the best sum over windows that do not overlap."""
    n = len(codes)
    bound = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        best = bound[i + 1] if widest else 0
        for w in range(1, min(widest, n - i) + 1):
            best = max(best, _window_cost(codes[i : i + w]) + bound[i + w])
        bound[i] = best
    return bound


def _letters(link: tuple | None) -> str:
    found = []
    while link is not None:
        link, letter = link
        found.append(letter)
    return "".join(reversed(found))


def _reaches(state: int, exits: tuple[int, ...]) -> bool:
    """Whether an exit can be reached: the first two states are not returned to."""
    return any(state <= e or e >= USER for e in exits)


def _dive(codes: bytes, entry: int, exits: tuple[int, ...], bound: list[int]) -> tuple[int, str] | None:
    """A first incumbent: at each node the edit of the least cost and bound."""
    n, i, state, cost, link, put = len(codes), 0, entry, 0, None, 0
    while i < n or state not in exits:
        options = _EDITS[codes[i], state] if i < n else [("I", 2, NEXT[state])]
        options = [(c + bound[i + (letter != "I")], letter, c, s) for letter, c, s in options if _reaches(s, exits) and (letter != "I" or put < 2)]
        if not options:
            return None
        _, letter, c, state = min(options)
        cost, link, put = cost + c, (link, letter), put + 1 if letter == "I" else 0
        i += letter != "I"
    return cost, _letters(link)


def _search(codes: bytes, entry: int, exits: tuple[int, ...], bound: list[int]) -> tuple[int, str] | None:
    """The least ``(cost, audit)`` from a state to one of ``exits``; none if there is no way."""
    n = len(codes)
    incumbent = _dive(codes, entry, exits, bound)
    least, own = (incumbent[0], False) if incumbent else (FAR, False)
    best = [FAR] * (4 * (n + 1))
    stack = [(0, entry, 0, None)]
    while stack:
        i, state, cost, link = stack.pop()
        # Until the search itself has an incumbent, an equal cost may still have a smaller audit.
        lowest = cost + bound[i]
        if lowest > least or (own and lowest == least) or cost >= best[4 * i + state]:
            continue
        best[4 * i + state] = cost
        if i == n:
            if state in exits:
                incumbent, least, own = (cost, _letters(link)), cost, True
                continue
            options = [("I", 2, NEXT[state])]
        else:
            options = _EDITS[codes[i], state]
        for letter, c, after in reversed(options):
            if _reaches(after, exits):
                stack.append((i + (letter != "I"), after, cost + c, (link, letter)))
    return incumbent


def cheapest(codes: bytes, entry: int = NOTHING, exits: tuple[int, ...] = ACCEPTED) -> tuple[int, str] | None:
    """The least ``(cost, audit)`` of rows from a state to one of ``exits``; solved ones are kept."""
    key = (codes, entry, exits)
    if key not in _solved:
        if len(_solved) >= KEPT:
            _solved.clear()
        _solved[key] = _search(codes, entry, exits, _suffix(codes, WINDOW))
    return _solved[key]


def joined(left: list[dict], right: list[dict]) -> list[dict]:
    """The least ways through two runs of rows, by entry and exit.

    Of two audits of one cost neither begins with the other, so the least stays least whatever follows.
    """
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for x in left:
        for y in right:
            if x["exit"] == y["entry"]:
                key, own = (x["entry"], y["exit"]), (x["cost"] + y["cost"], x["audit"] + y["audit"])
                if key not in best or own < best[key]:
                    best[key] = own
    return [{"entry": a, "exit": b, "cost": c, "audit": s} for (a, b), (c, s) in best.items()]


_WAYS = "array<struct<entry:int,exit:int,cost:bigint,audit:string>>"
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_FIELDS = "n_turns long, low long, high long, first string, last string, ways " + _WAYS + "".join(f", {c} long" for c in _COUNTS)


def _together(a: dict, b: dict) -> dict:
    """Two neighbouring runs of rows of a conversation as one."""
    turns = [x for x in (a["low"], b["low"], a["high"], b["high"]) if x is not None]
    same = a["high"] is not None and a["high"] == b["low"]
    return {c: a[c] + b[c] for c in _COUNTS} | {
        "illegal": a["illegal"] + b["illegal"] + (a["last"] + b["first"] not in LEGAL),
        "n_turns": a["n_turns"] + b["n_turns"] - same,
        "low": min(turns, default=None),
        "high": max(turns, default=None),
        "first": a["first"],
        "last": b["last"],
        "ways": joined(a["ways"], b["ways"]),
    }


def damaged(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: int = 20) -> DataFrame:
    """``id, turn, role, text, present``: the rows after damage; a dropped row stays with ``present`` false.

    Null ids and turns are one space in the key, null roles and texts are one
    space.  By the key's CRC-32 modulo ``parts``: 0 drops the row, 1 empties
    its text, 2 takes the ends of sentences out, 3 repeats it, 4 makes it the
    user's.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(shown(id), F.lit(":"), shown(turn))), F.lit(parts))
    rows = conversations.select(F.col(id), F.col(turn), shown(role).alias("role"), shown(text).alias("text"), fate.alias("fate"))
    own = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select(
        id, turn, F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), own.alias("text"), (F.col("fate") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def _same(text: Column, role: Column) -> Column:
    return F.unhex(F.sha2(F.concat(role, F.lit("\0"), text), 256))


def repaired(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str = "present", keep: bool = False) -> DataFrame:
    """``id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``; with ``keep`` also ``repaired``.

    One row for each id of ``rows``; rows that are not ``present`` only name
    their id.  Rows go by turn, nulls first; rows of one turn by role, then by
    the SHA-256 of role and text.  Null roles and texts are one space; rows of
    a null id are one conversation.  Columns of other names are ignored.

    ``blank``, ``duplicate`` and ``truncated`` count rows by their first fault
    and ``illegal`` neighbours; ``cost`` and ``audit`` are of the cheapest
    edits that leave ``(s?(ua)+)?``, the least audit of equals.  Without rows
    all are 0, the audit empty and the hash that of no text.
    """
    spark_type = rows.schema[id].dataType.simpleString()
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    all_rows = rows.select(F.col(id).alias("conv"), F.col(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"), F.col(present).alias("present"))
    last = F.right(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    facts = all_rows.filter("present").select(
        "conv", "turn", "role", _same(F.col("text"), F.col("role")).alias("sha"), F.substring("role", 1, 1).alias("initial"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
    )
    # A row that was seen earlier is not the first of its role and text; rows here are of fixed size.
    seen = Window.partitionBy("conv", "sha").orderBy(F.col("turn").asc_nulls_first())
    facts = facts.withColumn("again", F.row_number().over(seen) > 1)
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha"), F.col("again")]
    facts = facts.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = cut(facts.select(F.spark_partition_id().alias("part"), "conv", "turn", "initial", "blank", "again", "cut").mapInArrow(_pieces(spark_type), f"conv {spark_type}, part long, seq long, whole boolean, {_FIELDS}"))

    whole = pieces.filter("whole").drop("part", "seq", "whole")
    open_pieces = pieces.filter("NOT whole").drop("whole")
    while not open_pieces.isEmpty():
        place = F.row_number().over(Window.partitionBy("conv").orderBy("part", "seq")) - 1
        dealt = open_pieces.withColumn("place", place).withColumn("part", F.floor(F.col("place") / TOGETHER).cast("long"))
        merged = cut(dealt.groupBy("conv", "part").applyInArrow(_merge(), f"conv {spark_type}, part long, seq long, {_FIELDS}"))
        several = merged.groupBy("conv").agg(F.count("*").alias("n")).withColumnRenamed("conv", "own")
        same = F.col("conv").eqNullSafe(F.col("own"))
        ended = merged.join(several.filter("n = 1"), same, "left_semi")
        whole = whole.unionByName(ended.drop("part", "seq"))
        open_pieces = cut(merged.join(several.filter("n > 1"), same, "left_semi"))

    results = whole.select("conv", F.lit(0).alias("kind"), *[c.split()[0] for c in _FIELDS.split(", ")])
    texts = all_rows.select(
        "conv", F.when(F.col("present"), 1).otherwise(2).alias("kind"), "turn", "role", F.when(F.col("present"), _same(F.col("text"), F.col("role"))).alias("sha"),
        F.when(F.col("present"), F.col("text")).alias("text"),
    )
    both = results.unionByName(texts, allowMissingColumns=True)
    both = both.repartition("conv").sortWithinPartitions("conv", "kind", F.col("turn").asc_nulls_first(), "role", "sha").drop("sha")
    shown = ", repaired string" * keep
    schema = f"conv {spark_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string" + shown
    return both.mapInArrow(_render(keep), schema).withColumnRenamed("conv", id)


def _pieces(spark_type: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict = {}
        seq, first_conv, schema = 0, True, None

        def start(conv) -> dict:
            return {"conv": conv, "codes": bytearray(), "n_turns": 0, "low": None, "high": None, "first": None, "last": None, "alone": True} | dict.fromkeys(_COUNTS, 0)

        def ended(piece: dict, whole: bool) -> dict:
            codes = bytes(piece.pop("codes"))
            if whole:
                cost, audit = cheapest(codes)
                ways = [{"entry": NOTHING, "exit": NOTHING, "cost": cost, "audit": audit}]
            else:
                found = {(a, b): cheapest(codes, a, (b,)) for a in range(4) for b in range(4) if _reaches(a, (b,))}
                ways = [{"entry": a, "exit": b, "cost": w[0], "audit": w[1]} for (a, b), w in found.items() if w]
            piece.pop("alone")
            return piece | {"ways": ways, "whole": whole}

        for batch in batches:
            schema = schema or _piece_schema(batch)
            done = []
            columns = [batch.column(k).to_pylist() for k in ("conv", "turn", "initial", "blank", "again", "cut")]
            part = batch.column("part")[0].as_py() if batch.num_rows else 0
            for conv, turn, initial, blank, again, cut_off in zip(*columns):
                if now and (now["conv"] != conv or len(now["codes"]) >= SEGMENT):
                    other = now["conv"] != conv
                    # The first and the last conversation of a partition may go on in another one.
                    done.append(ended(now, other and now["alone"] and not first_conv) | {"part": part, "seq": seq})
                    seq += 1
                    first_conv = first_conv and not other
                    now = start(conv) | {"alone": other}
                elif not now:
                    now = start(conv)
                if turn is not None:
                    now["n_turns"] += turn != now["high"]
                    now["low"] = turn if now["low"] is None else now["low"]
                    now["high"] = turn
                if now["last"] is not None:
                    now["illegal"] += now["last"] + initial not in LEGAL
                else:
                    now["first"] = initial
                now["last"] = initial
                fault = "blank" if blank else "duplicate" if again else "truncated" if cut_off else None
                if fault:
                    now[fault] += 1
                kind = INITIALS.find(initial) if initial else -1
                now["codes"].append((kind if kind >= 0 else 3) | (REFUSED if blank or again else TRUNCATED if cut_off else 0))
            yield pa.RecordBatch.from_pylist(done, schema=schema)
        if now:
            yield pa.RecordBatch.from_pylist([ended(now, False) | {"part": part, "seq": seq}], schema=schema)

    return run


def _piece_schema(batch: pa.RecordBatch) -> pa.Schema:
    ways = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    names = [("conv", batch.schema.field("conv").type), ("part", pa.int64()), ("seq", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()), ("low", pa.int64()),
             ("high", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("ways", ways), *[(c, pa.int64()) for c in _COUNTS]]
    return pa.schema(names)


def _merge():
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        own = rows[0]
        for r in rows[1:]:
            own = rows[0] | _together(own, r)
        # The order of a run is that of its group.
        kept = own | {"part": rows[0]["part"], "seq": 0}
        return pa.Table.from_pylist([kept], schema=pa.schema([f for f in _piece_schema(table) if f.name != "whole"]))

    return run


def _render(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        schema = None

        def turns(state: dict) -> None:
            """Turns that the audit puts in before the next row."""
            while state["audit"][state["at"] : state["at"] + 1] == "I":
                state["at"] += 1
                put(state, None, "")

        def put(state: dict, role: str | None, text: str) -> None:
            if role is None:
                role = ("user", "assistant")[(state["out"] - state["system"]) % 2]
            line = ("\n" if state["out"] else "") + role + ":" + text
            state["hash"].update(line.encode())
            if keep:
                state["lines"].append(line)
            state["out"] += 1

        def begin(conv, row: dict | None) -> dict:
            best = min(((w["cost"], w["audit"]) for w in row["ways"] if w["entry"] == NOTHING and w["exit"] in ACCEPTED), default=(0, "")) if row else (0, "")
            counts = {c: row[c] if row else 0 for c in _COUNTS}
            gaps = row["high"] - row["low"] + 1 - row["n_turns"] if row and row["low"] is not None else 0
            # An odd number of turns begins with the system's.
            system = (len(best[1]) - best[1].count("D")) % 2
            return {"conv": conv, "gaps": gaps, "cost": best[0], "audit": best[1], "at": 0, "out": 0, "system": system, "hash": hashlib.sha256(), "lines": []} | counts

        def end(state: dict) -> dict:
            turns(state)
            return {"conv": state["conv"], "gaps": state["gaps"], "cost": state["cost"], "audit": state["audit"], "repaired_sha256": state["hash"].hexdigest()} | {
                c: state[c] for c in _COUNTS
            } | ({"repaired": "".join(state["lines"])} if keep else {})

        for batch in batches:
            if schema is None:
                schema = pa.schema(
                    [("conv", batch.schema.field("conv").type), ("gaps", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("cost", pa.int64()), ("audit", pa.string()),
                     ("repaired_sha256", pa.string()), *([("repaired", pa.string())] if keep else [])]
                )
            done = []
            for start in range(0, batch.num_rows, 1000):
                for row in batch.slice(start, 1000).to_pylist():
                    if now is None or now["conv"] != row["conv"]:
                        if now is not None:
                            done.append(end(now))
                        now = begin(row["conv"], row if row["kind"] == 0 else None)
                    if row["kind"] == 1:
                        turns(now)
                        letter = now["audit"][now["at"]]
                        now["at"] += 1
                        if letter != "D":
                            put(now, row["role"] if letter == "K" else None, row["text"])
            yield pa.RecordBatch.from_pylist(done, schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([end(now)], schema=schema)

    return run
