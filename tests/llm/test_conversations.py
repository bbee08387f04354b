import hashlib
import random

import oracle
import pytest
from pyspark.sql import functions as F

from millrace.llm import conversations as cv
from millrace.llm import minplus as mp


def every_way(kinds):
    """(cost, audit) by trying all edits, with up to two inserts in each gap (a third would come back to a state left before)."""
    found = []

    def go(i, state, cost, audit, inserts):
        if i == len(kinds) and state in mp.ACCEPT:
            found.append((cost, audit))
        for role in "ua":
            if inserts < 2 and (state, role) in mp.STEP:
                go(i, mp.STEP[state, role], cost + 2, audit + "I", inserts + 1)
        if i == len(kinds):
            return
        kind, cut = kinds[i].lower(), kinds[i].isupper()
        go(i + 1, state, cost + 3, audit + "D", 0)
        if kind != "d":
            if (state, kind) in mp.STEP:
                go(i + 1, mp.STEP[state, kind], cost + cut, audit + "K", 0)
            for role in "ua":
                if (state, role) in mp.STEP:
                    go(i + 1, mp.STEP[state, role], cost + 2 + cut, audit + "R", 0)

    go(0, 0, 0, "", 0)
    return min(found)


def test_cheapest_edits_by_trying_all():
    rng = random.Random(11)
    for n in range(6):
        for _ in range(60):
            kinds = "".join(rng.choices("suaxSUAXd", k=n))
            assert mp.cheapest(mp.product(kinds)) == every_way(kinds), kinds


def test_products_are_associative():
    rng = random.Random(12)
    for _ in range(40):
        kinds = "".join(rng.choices("suaxSUAXd", k=24))
        a, b = sorted(rng.sample(range(25), 2))
        parts = [mp.product(k) for k in (kinds[:a], kinds[a:b], kinds[b:])]
        assert mp.times(mp.times(parts[0], parts[1]), parts[2]) == mp.times(parts[0], mp.times(parts[1], parts[2])) == mp.product(kinds)


def plain(rows):
    """{conv: result} of rows (conv, turn, role, text, copies), one turn after another."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x, k in rows if c == conv for _ in range(k)]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, kinds, n = set(), "", dict.fromkeys(cv.COUNTS, 0)
        for _, role, text in mine:
            bare = text.strip(cv.WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            kind = role[:1] if role[:1] and role[:1] in "sua" else "x"
            kinds += "d" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
            if fault:
                n[fault] += 1
        n["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        turns = [t for t, _, _ in mine if t is not None]
        cost, audit = mp.cheapest(mp.product(kinds)) if len(mine) > 5 else every_way(kinds)
        fixed, at, m = [], 0, len(audit) - audit.count("D")
        for e in audit:
            at += e != "I"
            if e != "D":
                role = "user" if (len(fixed) - m % 2) % 2 == 0 else "assistant"
                fixed.append((mine[at - 1][1] if e == "K" else role, "" if e == "I" else mine[at - 1][2]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *n.values(), cost, audit, hashlib.sha256("\n".join(map(":".join, fixed)).encode()).hexdigest(), fixed)
    return out


def check(spark, rows, **how):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies long").repartition(5)
    got = cv.repair(df, copies=F.col("copies"), **how)
    want = plain(rows)
    mine = {r.conv_id: tuple(r)[1:] for r in got.summary.select("conv_id", "gaps", *cv.COUNTS, "cost", "audit", "repaired_sha256").collect()}
    assert mine == {k: v[:-1] for k, v in want.items()}
    fixed = {}
    for r in sorted(got.turns.collect(), key=lambda r: (r.conv_id is None, r.conv_id or 0, r.place)):
        assert r.place == len(fixed.setdefault(r.conv_id, []))
        fixed[r.conv_id].append((r.role, r.text))
    assert fixed == {k: v[-1] for k, v in want.items() if v[-1]}
    return got


def talk(rng, conv, n, roles=("user", "assistant", "system", "tool")):
    texts = ["Well.", "So it goes!", "cut off", "", " \n", "Is it? ", "x" * 50 + "."]
    return [(conv, rng.choice([None, i, i, i, i // 2]), rng.choice(roles), rng.choice([*texts, f"Turn {i} of its own.", f"Turn {i} cut"]), rng.choice([1, 1, 1, 2, 0, 3])) for i in range(n)]


def test_matches_sql(spark, duck, sf):
    got_cols, got, want_cols, want = oracle.both(spark, duck, cv.op11_conversation_repair, cv.ORACLE_SQL, sf)
    assert got_cols == want_cols and got == want and len(got) > 5


def test_odd_rows_match_sql(spark, tmp_path):
    rng = random.Random(13)
    rows = [r[:4] for c in range(60) for r in talk(rng, c, rng.randrange(9))] + [(None, None, None, None), (None, 1, "user", "Here."), (None, 1, "user", "Here."), (7, None, "", "."), (3000000000, 2**40, "assistant", "One!")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    got_cols, got, want_cols, want = oracle.both(spark, con, cv.op11_conversation_repair, cv.ORACLE_SQL, str(tmp_path))
    assert got_cols == want_cols and got == want


def test_small_conversations(spark):
    rng = random.Random(14)
    check(spark, [r for c in range(120) for r in talk(rng, c, rng.randrange(1, 6))])


@pytest.mark.parametrize(("segment", "buffer"), [(7, 1 << 20), (1 << 14, 200), (3, 0)])
def test_one_conversation_spread_over_all_tasks(spark, segment, buffer):
    rng = random.Random(15)
    rows = talk(rng, 1, 900) + talk(rng, 2, 40) + talk(rng, None, 60, ("user", "assistant")) + [(3, 5, "user", "The same row!", 400), (4, 1, "user", "gone", 0)]
    got = check(spark, rows, segment=segment, buffer=buffer)
    assert got.summary.where("conv_id = 4 and cost = 0 and audit = ''").count() == 1


def test_odd_tables(spark):
    schema = "conv_id string, turn int, role string, text string, part int, sub long, state string, cost int"
    rows = [("a", 1, "user", "Long " * 400_000 + "end.", 1, 2, "s", 3), ("a", 2, "assistant", "Fine.", 1, 2, "s", 3), ("b", None, None, None, None, None, None, None)]
    out = cv.repair(spark.createDataFrame(rows, schema))
    assert {(r.conv_id, r.cost, r.audit, r.blank) for r in out.summary.collect()} == {("a", 0, "KK", 0), ("b", 3, "D", 1)}
    assert out.turns.where("conv_id = 'a' and length(text) > 1000000").count() == 1
    none = cv.repair(spark.createDataFrame([], schema))
    assert none.summary.count() == 0 and none.turns.count() == 0
