import hashlib

from frames import CLASHING, SF
from pyspark.sql import functions as F
from viewlens.checks.compare import compare_one, duck
from viewlens.llm import chat
from viewlens.llm.queries import QUERIES, SQL

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <b> # \\ </turn>\n### user: x"), (1, 2, "assistant", None), (1, 3, "user", ""),
        (2, None, "user", "q"), (2, 5, None, "r:o\nle"), (None, 0, "assistant", "\\l\\b\\h\\"), (3, 0, "user", "only"),
        (4, 1, "assistant", "tie"), (4, 1, "assistant", "tie"), (4, 1, "user", "tie"), (5, 0, "sys: tem\n", "é\U0001f600")]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_sql(spark):
    r = compare_one(spark, duck(SF), "op2", QUERIES["op2_chat_prefix_targets"], SQL["op2_chat_prefix_targets"], SF)
    assert r["ok"], r


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHING if c != "text"})


def test_round_trip(spark):
    got = {r.conv_id: r for r in chat.digests(frame(spark)).collect()}
    for conv in {r[0] for r in ROWS}:
        own = sorted((r for r in ROWS if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        g = got[conv]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (len(own), sha(said), len(loss), sha(loss)), conv
        assert g.n_examples == sum(r[2] == "assistant" for r in own)


def test_examples_are_prefixes_with_one_trained_reply(spark):
    rendered = chat.turns(frame(spark))
    texts = {r.conv_id: r.formatted for r in chat.formatted(rendered).collect()}
    rows = chat.example_texts(chat.prefix_targets(rendered), chat.formatted(rendered)).collect()
    assert len(rows) == sum(r[2] == "assistant" for r in ROWS)
    for r in rows:
        whole = texts[r.conv_id]
        assert whole.startswith(r.text) and r.text.endswith("</turn>\n") and len(r.text) == r.prefix_end
        assert r.text[r.target_start:r.target_end] == r.target
        assert r.text[:r.target_start].endswith("### assistant: ")


def test_empty(spark):
    assert chat.digests(frame(spark).limit(0)).count() == 0


def test_masks_cut_the_replies_out_of_the_output(spark):
    whole = chat.formatted_examples(chat.turns(frame(spark)))
    spans = {(r.conv_id, r.example): r for r in chat.prefix_targets(chat.turns(frame(spark))).collect()}
    for r in whole.collect():
        data = r.formatted.encode()
        for k, m in enumerate(r.masks):
            e = spans[r.conv_id, k]
            assert data[m.mask_from:m.mask_to].decode() == r.formatted[e.target_start:e.target_end] == e.target


def test_a_shifted_mask_changes_the_digest(spark):
    whole = chat.formatted_examples(chat.turns(frame(spark)))
    right = {r.conv_id: r for r in chat.digests_of(whole).collect()}
    for by in (-1, 1):
        moved = F.transform("masks", lambda m: F.struct(m["pos"], (m["mask_from"] + by).alias("mask_from"), (m["mask_to"] + by).alias("mask_to")))  # noqa: B023
        for r in chat.digests_of(whole.withColumn("masks", moved)).collect():
            assert r.turns_sha256 == right[r.conv_id].turns_sha256
            if right[r.conv_id].n_examples:
                assert r.loss_sha256 != right[r.conv_id].loss_sha256


def test_one_shuffle(spark):
    plan = chat.digests(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(conv_id") == 1 and plan.count("Exchange ") == 1


def test_a_prefix_example_for_each_reply(spark):
    whole = chat.formatted_examples(chat.turns(frame(spark)))
    rendered = chat.turns(frame(spark))
    want = {(r.conv_id, r.example): (r.text, r.target) for r in chat.example_texts(chat.prefix_targets(rendered), chat.formatted(rendered)).collect()}
    rows = chat.prefix_examples(whole, "conv_id").collect()
    got = {(r.conv_id, r.example): (r.text, r.text.encode()[r.mask_from:r.mask_to].decode()) for r in rows if r.example is not None}
    assert got == want and len(got) == sum(r[2] == "assistant" for r in ROWS)
    assert sorted(r.conv_id for r in rows if r.example is None) == [2, 3, 5]


def test_the_loss_is_read_from_the_prefix_examples(spark, monkeypatch):
    whole = chat.formatted_examples(chat.turns(frame(spark)))
    right = {r.conv_id: r for r in chat.digests_of(whole).collect()}
    cut = chat.prefix_examples
    monkeypatch.setattr(chat, "prefix_examples", lambda *a: cut(*a).withColumn("text", F.expr("substring(text, 1, length(text) - 10)")))
    for r in chat.digests_of(whole).collect():
        assert (r.n_turns, r.turns_sha256, r.n_examples) == (right[r.conv_id].n_turns, right[r.conv_id].turns_sha256, right[r.conv_id].n_examples)
        assert (r.loss_chars < right[r.conv_id].loss_chars) == (right[r.conv_id].loss_chars > 0), r.conv_id
