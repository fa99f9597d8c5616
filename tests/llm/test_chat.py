import random

from pyspark.sql import functions as F

from tapekeeper.llm import chat


def shown(turns):
    return "".join(f"<|{r or ''}|>\n{(t or '').replace('<|', '< |')}<|end|>\n" for r, t in turns)


def mask_of(turns):
    out = []
    for r, t in turns:
        out += [(len(f"<|{r or ''}|>\n"), False), (len((t or "").replace("<|", "< |") + "<|end|>\n"), r == "assistant")]
    return out


def table(spark, conversations):
    rows = [(p, n, r, t, "x", 1) for p, turns in conversations.items() for n, (r, t) in enumerate(turns)]
    random.Random(4).shuffle(rows)
    return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string, side string, prompt int").repartition(3)


def test_against_brute_force(spark):
    rng = random.Random(7)
    turns = [("user", "hi"), ("assistant", "ho"), ("system", ""), ("user", None), (None, "x"), ("assistant", "<|user|> é🙂"),
             ("assistant", "long " * 5000)]
    chosen = {p: [rng.choice(turns) for _ in range(rng.randint(1, 8))] for p in range(60)}
    rejected = {}
    for p, mine in chosen.items():
        cut = rng.randint(0, len(mine))
        rejected[p] = mine[:cut] + [rng.choice(turns) for _ in range(rng.randint(0, 4))]
    del chosen[5], rejected[6]
    rejected[7] = list(chosen[7])
    found = {r.pair_id: r for r in chat.format_preferences(table(spark, chosen), table(spark, rejected)).collect()}
    assert set(found) == set(chosen) | {p for p, t in rejected.items() if t}
    for p, r in found.items():
        c, d = ([(a or "", (b or "")) for a, b in side.get(p, [])] for side in (chosen, rejected))
        k = 0
        while k < min(len(c), len(d)) and c[k] == d[k]:
            k += 1
        assert (r.prefix_turns, r.prompt, r.chosen, r.rejected) == (k, shown(c[:k]), shown(c[k:]), shown(d[k:]))
        for mask, rest, text in ((r.chosen_mask, c[k:], r.chosen), (r.rejected_mask, d[k:], r.rejected)):
            assert [tuple(m) for m in mask] == mask_of(rest) and sum(m.chars for m in mask) == len(text)
        assert r.differs == (c != d)


def test_null_pairs_ties_and_empty_tables(spark):
    same = [(None, 1, "user", "b"), (None, 1, "user", "a"), (None, None, "user", "first"), (1, 1, "user", "a"), (1, 1, "user", "a")]
    rows = spark.createDataFrame(same, "pair_id long, turn long, role string, text string")
    found = {r.pair_id: r for r in chat.format_preferences(rows, rows.repartition(3)).collect()}
    assert set(found) == {1} and found[1].prefix_turns == 2
    assert chat.format_preferences(rows.limit(0), rows.limit(0)).count() == 0


def test_plan_is_native_with_one_shuffle(spark):
    rows = table(spark, {1: [("user", "a")]})
    plan = chat.format_preferences(rows, rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan and "Pandas" not in plan


def test_long_conversations(spark):
    long = [("user" if i % 2 else "assistant", f"turn {i} " + "x" * 500) for i in range(3000)]
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(long)], "pair_id long, turn long, role string, text string")
    other = rows.withColumn("text", F.when(F.col("turn") == 2990, "else").otherwise(F.col("text")))
    (found,) = chat.format_preferences(rows, other.repartition(4)).collect()
    assert found.prefix_turns == 2990 and found.prompt == shown(long[:2990]) and found.chosen == shown(long[2990:])
