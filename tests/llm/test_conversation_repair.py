"""Conversation repair against all states of every conversation, and on small pieces."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import conversation_repair as repair
from llm import samples

BLANK = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Best (cost, letters, rows) to every state, over all edits; ``rows`` are (role, text, fault)."""

    def after(state, role):
        initial = role[:1]
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def inserted(best):
        for _ in range(4):
            for state, (cost, letters, out) in list(best.items()):
                for role in ("user", "assistant"):
                    if new := after(state, role):
                        offer = (cost + 5, letters + "I", [*out, (role, "")])
                        best[new] = min(best.get(new, offer), offer, key=lambda x: x[:2])
        return best

    best = inserted({"": (0, "", [])})
    for role, text, fault in rows:
        new = {}

        def offer(state, cost, letters, out):
            if state not in new or (cost, letters) < new[state][:2]:
                new[state] = (cost, letters, out)

        for state, (cost, letters, out) in best.items():
            offer(state, cost + 2, letters + "D", out)
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if kept := after(state, role):
                    offer(kept, cost + extra, letters + "K", [*out, (role, text)])
                for other in ("user", "assistant"):
                    if kept := after(state, other):
                        offer(kept, cost + extra + 1, letters + "R", [*out, (other, text)])
        best = inserted(new)
    return min((best[state] for state in ("", "a") if state in best), key=lambda x: x[:2])


def expected(given):
    held = defaultdict(list)
    for conversation, turn, role, text in given:
        held[conversation]  # noqa: B018
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conversation is None else conversation}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        held[conversation] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conversation, rows in held.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [r[0] for r in rows if r[0] is not None]
        seen, faulted = set(), []
        for _, role, text in rows:
            visible = BLANK.findall(text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            faulted.append((role, text, fault))
        counts = [sum(f == name for *_, f in faulted) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(faulted, faulted[1:], strict=False))
        cost, letters, repaired = cheapest(faulted)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in repaired).encode()).hexdigest()
        out.append((conversation, gaps, *counts, illegal, cost, letters, digest))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def conversations(seed, n, most):
    rng = random.Random(seed)
    texts = ["yes.", "no!", "why?", "cut off", "", " \n", "é.", "a.  \t", "x" * 70 + ".", "x" * 70 + "!", None]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "user", "", "usher", None]
    rows = []
    for i in range(n):
        turn = 0
        for _ in range(rng.randint(0, most)):
            turn += rng.choice([0, 1, 1, 1, 1, 2, 5])
            rows.append((i, rng.choice([None, *[turn] * 9]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"{rng.random()}."))
    return rows + rows[:7] + [(None, 1, "user", "null id."), (None, None, "assistant", "null id.")]


def as_query(spark, monkeypatch, df):
    monkeypatch.setattr(repair.tables, "table", lambda *_: df)
    return repair.op11_conversation_repair(spark, "")


@pytest.mark.parametrize("seed,n,most,piece", [(1, 150, 9, None), (2, 12, 120, 7), (3, 3, 900, 16), (4, 60, 12, 1)])
def test_brute_force(spark, monkeypatch, seed, n, most, piece):
    """Short conversations, and long ones cut into many pieces over all partitions."""
    rows = conversations(seed, n, most)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"piece": F.lit("x"), "conversation": F.lit(1)})
    if piece:
        # A session's Python workers take the function with its values.
        cut = repair._cut
        monkeypatch.setattr(repair, "_cut", lambda schema: _with_piece_rows(cut(schema), piece))
    assert found(as_query(spark, monkeypatch, df)) == expected(rows)


def _with_piece_rows(function, rows):
    def run(batches):
        from corpusloom.llm import conversation_repair

        before, conversation_repair.PIECE_ROWS = conversation_repair.PIECE_ROWS, rows
        try:
            yield from function(batches)
        finally:
            conversation_repair.PIECE_ROWS = before

    return run


def test_block_tables():
    """Few vectors; blocks give what single steps give."""
    made = repair.block_tables()
    assert len(made.vectors) < 60 and made.block.shape[0] == 9**repair.BLOCK
    rng = random.Random(1)
    for n in range(12):
        symbols = bytes(rng.randrange(9) for _ in range(n))
        costs = list(repair._END)
        for symbol in reversed(symbols):
            costs = repair._step(symbol, tuple(costs))
        total, bounds = made.before(symbols, 0)
        assert [total + x for x in made.vectors[bounds[0]]] == costs
        steps = repair.matrix(symbols)
        if n:
            assert [min(steps[4 * a + b] + repair._END[b] for b in range(4)) for a in range(4)] == costs


def test_many_equal_rows_and_a_long_text(spark, monkeypatch):
    rows = [(1, 1, "user", "same."), (1, 2, "assistant", "word " * 300_000 + ".")] + [(1, 3, "user", "again.")] * 9_000 + [(2, None, None, None)]
    assert found(as_query(spark, monkeypatch, spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_empty(spark, monkeypatch):
    assert as_query(spark, monkeypatch, spark.createDataFrame([], SCHEMA)).collect() == []
    assert repair.repair(samples.empty(spark), "doc_id", "n_chars", "lang").collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = found(repair.op11_conversation_repair(spark, folder))
    assert result == expected(rows) and len(result) == len({r[0] for r in rows})
    assert {letter for r in result for letter in r[7]} >= set("DKR")
