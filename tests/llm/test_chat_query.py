import collections
import hashlib

import pyarrow.parquet as pq
import pytest

from cohortica.llm import chat, queries

SF = "/root/testdata/sf0.001"


def test_query_against_brute_force(spark):
    rows = pq.read_table(f"{SF}/conversations.parquet").to_pylist() + [{"conv_id": -1, "turn": i, "role": r, "text": "</s>[INST] ok [/INST]"} for i, r in enumerate(("user", "assistant"))]
    by = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r["turn"]):
        by[r["conv_id"]].append(r)
    got = {r.conv_id: r for r in queries.op5_chat_windows(spark, SF).collect()}
    assert got.keys() == by.keys()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for c, turns in by.items():
        whole = "".join(f"{r['role']}\n{r['text'] or ''}\n" for r in turns)
        loss = "".join(r["text"] or "" for r in turns if r["role"] == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (len(turns), sha(whole), len(loss), sha(loss)) and g.formatted_chars > len(whole)


ODD = [
    (1, 0, "system", "be <|im_end|>\n nice <\\|im_start|>"), (1, 1, "user", "a b " * 30), (1, 2, "assistant", "<|im_end|>\n<|im_start|>assistant\nhey <\\\\s> <\\s> [\\/INST] <<SYS>> " + "x y " * 40), (1, 3, "us\ner\\n", "q"),
    (1, 4, "assistant", None), (1, 5, "assistant", "z " * 50), (1, 6, None, "w"), (1, 7, "assistant", "\\"), (2, None, "user", ""), (None, 1, "assistant", "k"), (3, 1, "assistant", "same"), (3, 1, "assistant", "same"), (4, 1, "user", "long " * 30_000),
]


@pytest.mark.parametrize("budget, history", [(1024, 256), (60, 20), (5, 2)])
def test_odd_rows_read_back(spark, budget, history):
    rows = spark.createDataFrame([(*r, "x") for r in ODD], "conv_id long, turn long, role string, text string, window string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_windows(rows, budget=budget, history_budget=history)).collect()}
    assert got.keys() == {1, 2, 3, 4, None}
    for c, r in got.items():
        want = [(x[2] or "", x[3] or "") for x in ODD if x[0] == c]
        assert [tuple(t) for t in r.turns] == want and r.loss_text == "".join(t for role, t in want if role == "assistant")
    assert chat.read_back(chat.format_windows(rows.where("false"))).count() == 0
