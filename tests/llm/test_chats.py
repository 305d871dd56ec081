import numpy as np

from textfeat.llm import chats, queries


def folded(events):
    """Final texts by message: the log read in order of seq."""
    held = {}
    for seq, message, kind, text in sorted(events):
        if kind == "delta":
            held[message] = held.get(message, "") + text
        else:
            held[message] = text
            if kind == "regenerate":
                held = {m: t for m, t in held.items() if m <= message}
    return held


def test_many_regenerations_of_one_conversation(spark):
    rng = np.random.default_rng(4)
    kinds = rng.choice(["delta", "edit", "regenerate"], 600, p=[0.8, 0.1, 0.1])
    events = [(seq, int(rng.integers(0, 40)), str(kind), f"t{seq} ") for seq, kind in enumerate(kinds)]
    rows = [(c, s, m, k, "user", t) for c in (1, None) for s, m, k, t in events]
    log = spark.createDataFrame(rows, "conv_id long, seq long, message long, kind string, role string, text string")
    result = chats.fold(log)
    assert "collect_list(struct(message" not in result._jdf.queryExecution().optimizedPlan().toString()
    found = {c: {r.message: r.text for r in result.collect() if r.conv_id == c} for c in (1, None)}
    assert found[1] == found[None] == folded(events)


def test_registered_query_folds_a_real_log(spark):
    rows = [(c, t, "user", f"text {c} {t}") for c in range(20) for t in range(6)]
    rows += [(50, 0, "user", "twice"), (50, 0, "user", "twice"), (50, None, None, None), (None, 3, "assistant", "x"), (51, 1, "user", "é")]
    log = queries.chat_log(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    found = [(r.conv_id, r.message.turn, r.role, r.text) for r in chats.fold(log).collect()]
    assert sorted(found, key=str) == sorted([(c, t, r or "", x or "") for c, t, r, x in rows], key=str)
