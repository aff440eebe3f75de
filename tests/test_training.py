"""Masks and weights: results written out for named texts, and what holds for any text."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from eventloom import vocab
from eventloom.functions.running import running_before
from eventloom.functions.text import TOKEN_PATTERN, tokens
from eventloom.operators import conversations, training

HEADER = "<|start_header_id|>assistant<|end_header_id|>"
OPEN, CLOSE, END = vocab.TOOL_RESPONSE_START, vocab.TOOL_RESPONSE_END, vocab.END_OF_TURN


def cut(text: str) -> list[str]:
    return [m.group(0) for m in re.finditer(TOKEN_PATTERN, text)]


PIECES = [
    "word", " ", "\n", "é漢", "x", "$.", "$", ".", ")", "(", "json_extract(METADATA, '$.site')", "json_extract(METADATA, '$.a",
    "json_extract(METADATA,'$.b')", "my_json_extract(METADATA, '$.c') ", "<TOOL_RESPONSE>", "</TOOL_RESPONSE>", "<|eot_id|>",
    "<|start_header_id|>assistant<|end_header_id|>", "<|x", "TOOL_RESPONSE",
]


def random_messages(seed: int, n_conversations: int):
    rng = random.Random(seed)
    rows = []
    for conv in range(n_conversations):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["system", "user", "assistant", "assistant", "tool"])
            content = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 9)))
            tool = vocab.SQL_TOOL if role == "assistant" and rng.random() < 0.4 else None
            arguments = '{"sql": "SELECT json_extract(METADATA, \'$.k\')"}' if tool else None
            rows.append((conv, turn, turn, role, content, tool, arguments, True, True))
    return rows


SCHEMA = "conv_id bigint, seq bigint, turn bigint, role string, content string, tool_name string, tool_args string, opens boolean, closes boolean"


@pytest.mark.parametrize("limit", [17, 60, None])
def test_weights_are_zero_exactly_where_nothing_is_learned(spark, limit):
    messages = spark.createDataFrame(random_messages(limit or 5, 150), SCHEMA)
    segments = conversations.render_segments(messages)
    placed = training.positioned(training.measure(segments))
    result = training.loss_weights(placed, limit).select(
        "conv_id", "seq", training.flags().alias("trained"), training.all_weights().alias("weights"), tokens("kept_text").alias("t")
    )
    texts: dict = {}
    for row in segments.orderBy("conv_id", "seq").collect():
        texts[row.conv_id] = texts.get(row.conv_id, "") + row.segment
    got: dict = {}
    for row in result.orderBy("conv_id", "seq").collect():
        got.setdefault(row.conv_id, []).append(row)
        assert [w > 0 for w in row.weights] == row.trained
        assert set(row.weights) <= {0.0, 1.0, 2.0, 20.0}
    for conv, text in texts.items():
        assert [t for r in got[conv] for t in r.t] == cut(text)[:limit]


def learned_text(spark, role: str, content: str, limit=None) -> str:
    row = training.label_mask(one_message(spark, role, content), limit).withColumn("trained", training.flags()).first()
    return "".join(t for t, y in zip(cut(row.kept_text), row.trained) if y)


LEARNED = {
    "plain answer": ("assistant", "yes it is", "\n\nyes it is" + END),
    "user message": ("user", "yes it is", ""),
    "response quoted": ("assistant", f"a{OPEN}b{CLOSE}c", "\n\nac" + END),
    "two responses": ("assistant", f"{OPEN}1{CLOSE} and {OPEN}2{CLOSE}.", "\n\n and ." + END),
    "response without end": ("assistant", f"a{OPEN}b", f"\n\na{OPEN}b" + END),
    "response without start": ("assistant", f"a{CLOSE}b", f"\n\na{CLOSE}b" + END),
    "response opened twice": ("assistant", f"a{OPEN}b{OPEN}c{CLOSE}d", "\n\nad" + END),
    "header inside a user's text": ("user", f"x{HEADER}y", "y" + END),
    "end tag inside the text": ("assistant", f"a{END}b", "\n\na" + END),
    "half a tag": ("assistant", "<|eot_i TOOL_RESPONSE>", "\n\n<|eot_i TOOL_RESPONSE>" + END),
}


@pytest.mark.parametrize("name", LEARNED)
def test_what_is_learned(spark, name):
    role, content, expected = LEARNED[name]
    assert learned_text(spark, role, content) == expected


def test_taking_a_pair_of_response_tags_away_learns_its_span(spark):
    inside = learned_text(spark, "assistant", f"before {OPEN}the span{CLOSE} after")
    assert learned_text(spark, "assistant", "before the span after") == inside.replace("before ", "before the span")


def weighted_text(spark, content: str, shift: str = "") -> list[tuple[str, float]]:
    """Runs of equal weight in an assistant message that calls the SQL tool."""
    rows = [(0, 0, 0, "user", shift, None, None, True, True), (0, 1, 1, "assistant", content, vocab.SQL_TOOL, "{}", True, True)]
    placed = training.positioned(training.measure(conversations.render_segments(spark.createDataFrame(rows, SCHEMA))))
    row = training.loss_weights(placed).where("seq = 1").first()
    runs: list = []
    for token, weight in zip(cut(row.segment), row.weights):
        if runs and runs[-1][1] == weight:
            runs[-1] = (runs[-1][0] + token, weight)
        else:
            runs.append((token, weight))
    return runs


def test_weights_of_a_metadata_access(spark):
    runs = weighted_text(spark, "see json_extract(METADATA, '$.site') of $.x")
    tail = '<TOOLCALL>[{"name": "execute_sql", "arguments": {}}]</TOOLCALL>' + END
    assert runs == [
        (HEADER, 0.0), ("\n\nsee ", 1.0), ("json_extract(METADATA, '", 2.0), ("$.", 20.0), ("site')", 2.0), (" of ", 1.0), ("$.", 20.0),
        ("x" + tail, 1.0),
    ]
    assert weighted_text(spark, "see json_extract(METADATA, '$.site') of $.x", "moves everything on") == runs
    spaced = weighted_text(spark, "json_extract(METADATA,'$.site')")
    assert (2.0 not in {w for _, w in spaced}) and ("$.", 20.0) in spaced


def one_message(spark, role: str, content: str):
    row = (0, 0, 0, role, content, None, None, True, True)
    return training.positioned(training.measure(conversations.render_segments(spark.createDataFrame([row], SCHEMA))))


def test_block_without_end_tag_is_not_learned(spark):
    masked = training.label_mask(one_message(spark, "assistant", "a b c"), 6).first()
    assert masked.n_kept == 6 and not any(masked.trained or [])


def test_response_inside_assistant_text_is_masked(spark):
    masked = training.label_mask(one_message(spark, "assistant", "a<TOOL_RESPONSE>b</TOOL_RESPONSE>c"), 100)
    shown = masked.select(training.masked_view().alias("v")).first().v
    assert shown.endswith("\n\na" + vocab.PLACEHOLDER * 8 + "c" + vocab.END_OF_TURN)


# --- any tokenizer -----------------------------------------------------------------

TAGS = r"<\|[a-z_]+\|>"


def by_threes(text):
    """Tags are tokens; all else is cut into runs of up to three characters, across any other border."""
    return F.regexp_extract_all(text, F.lit(rf"(?s){TAGS}|(?:(?!{TAGS}).){{1,3}}"), F.lit(0))


def slow_threes(text: str) -> list[str]:
    return re.findall(rf"(?s){TAGS}|(?:(?!{TAGS}).){{1,3}}", text)


def masked_by_threes(spark, rows, limit=None):
    segments = conversations.render_segments(spark.createDataFrame(rows, SCHEMA))
    placed = training.positioned(training.measure(segments, by_threes))
    return training.loss_weights(placed, limit, by_threes).withColumn("flags", training.flags()).withColumn("w", training.all_weights())


def test_masks_written_out_for_another_tokenizer(spark):
    rows = [(0, 0, 0, "user", "q", None, None, True, True), (0, 1, 1, "assistant", f"yes{OPEN}no{CLOSE}so", None, None, True, True)]
    shown = masked_by_threes(spark, rows).withColumn("shown", training.masked_view()).orderBy("seq").collect()
    assert slow_threes(shown[1].segment) == [
        "<|start_header_id|>", "ass", "ist", "ant", "<|end_header_id|>", "\n\ny", "es<", "TOO", "L_R", "ESP", "ONS", "E>n", "o</",
        "TOO", "L_R", "ESP", "ONS", "E>s", "o", "<|eot_id|>",
    ]
    p = vocab.PLACEHOLDER
    assert shown[1].shown == p * 5 + "\n\ny" + p * 12 + "o<|eot_id|>"
    assert shown[0].shown == p * len(slow_threes(shown[0].segment))


@pytest.mark.parametrize("limit", [None, 20])
def test_labels_cuts_and_weights_follow_the_tokenizer(spark, limit):
    rows = random_messages(3, 80)
    texts, want = {}, {}
    for row in conversations.render_segments(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "seq").collect():
        texts.setdefault(row.conv_id, []).append(row.segment)
    result = masked_by_threes(spark, rows, limit).withColumn("labels", training.labels()).orderBy("conv_id", "seq").collect()
    got = {}
    for r in result:
        got.setdefault(r.conv_id, []).append(r)
        assert len(r.flags) == len(r.w) == len(r.labels) == r.n_kept == len(slow_threes(r.kept_text))
        assert [y != vocab.IGNORE_LABEL for y in r.labels] == r.flags == [w > 0 for w in r.w]
    for conv, parts in texts.items():
        cut_tokens = [t for text in parts for t in slow_threes(text)][:limit]
        assert [t for r in got[conv] for t in slow_threes(r.kept_text)] == cut_tokens
        want = slow_learned([r.kept_text for r in got[conv]])
        assert [t for r in got[conv] for t in r.flags] == want


def slow_learned(texts: list[str]) -> list[bool]:
    """Which tokens lie in an answer and touch no response, over the text of a whole conversation."""
    text, flags, at = "".join(texts), [], 0
    answers, begin = [], 0
    for part in texts:
        answers += [(begin + m.start(1), begin + m.end(1)) for m in re.finditer(rf"(?s){re.escape(HEADER)}(.*?{re.escape(END)})", part)]
        begin += len(part)
    responses = [m.span() for m in re.finditer(rf"(?s){OPEN}.*?{CLOSE}", text)]
    for part in texts:
        for t in slow_threes(part):
            a, b = at, at + len(t)
            flags.append(any(s <= a and b <= e for s, e in answers) and not any(s < b and a < e for s, e in responses))
            at = b
    return flags


def test_weights_touch_spans_by_character(spark):
    rows = [(0, 0, 0, "assistant", "a json_extract(METADATA, '$.k') b", vocab.SQL_TOOL, "{}", True, True)]
    row = masked_by_threes(spark, rows).first()
    call = row.segment.index("json_extract("), row.segment.index(")") + 1
    mark = row.segment.index("$."), row.segment.index("$.") + 2
    at = 0
    for t, w in zip(slow_threes(row.segment), row.w):
        touches = [s < at + len(t) and at < e for s, e in (call, mark)]
        assert w in (0.0, 20.0 if touches[1] else 2.0 if touches[0] else 1.0)
        at += len(t)


def test_spans_and_tokens_as_sorted_arrays(spark):
    from eventloom.functions.spans import count_upto, covered, ends_of, spans_of

    draw = random.Random(9)
    rows = []
    for _ in range(150):
        pieces = ["x" * draw.randint(1, 4) for _ in range(draw.randint(0, 40))]
        size = sum(map(len, pieces))
        spans = sorted((a, a + draw.randint(1, 9)) for a in (draw.randint(0, size) for _ in range(draw.randint(0, 6))))
        rows.append((pieces, [{"start": a, "stop": b} for a, b in spans]))
    frame = spark.createDataFrame(rows, "pieces array<string>, spans array<struct<start: int, stop: int>>").withColumn("ends", ends_of(F.col("pieces")))
    made = frame.select("*", covered(F.col("ends"), F.col("spans")).alias("touched"), count_upto(F.col("ends"), F.lit(20)).alias("n")).collect()
    for r in made:
        ends = [sum(len(p) for p in r.pieces[: i + 1]) for i in range(len(r.pieces))]
        assert r.ends == ends and r.n == sum(e <= 20 for e in ends)
        assert r.touched == [any(s.start < e and e - len(p) < s.stop for s in r.spans) for p, e in zip(r.pieces, ends)]
    text = "é" + "ab$.x" * 40
    found = spark.createDataFrame([(text,)], "t string").select(spans_of("t", r"\$\.").alias("s")).first().s
    assert [(x.start, x.stop) for x in found] == [m.span() for m in re.finditer(r"\$\.", text)]


def test_catalogue_is_counted_once_with_the_same_result(spark):
    rows = [(0, 0, 0, "system", "see <TOOLS>[1, 2]</TOOLS> there", None, None, "[1, 2]", True, True), (0, 1, 1, "user", "q", None, None, None, True, True)]
    segments = conversations.render_segments(
        spark.createDataFrame(rows, "conv_id bigint, seq bigint, turn bigint, role string, content string, tool_name string, tool_args string, tools string, opens boolean, closes boolean")
    )
    plain = training.measure(segments).select("seq", "n_tokens").collect()
    assert sorted(map(tuple, training.measure(segments, catalogue="[1, 2]").select("seq", "n_tokens").collect())) == sorted(map(tuple, plain))


# --- needles over messages -----------------------------------------------------------


@pytest.mark.parametrize("needle", [["a"], ["a", "a"], ["a", "a", "a", "a", "a"], ["a", "b", "a"], ["b", "a", "a", "b"], ["c"], []])
def test_needle_over_messages(spark, needle):
    draw = random.Random(len(needle))
    rows, whole = [], {}
    for conv in range(40):
        for seq in range(draw.randint(1, 9)):
            text = "".join(draw.choices("aab", k=draw.choice([0, 1, 1, 1, 2, 5, 12])))
            rows.append((conv if conv else None, seq, "user", None, text))
            whole.setdefault(conv if conv else None, []).extend(text)
    segments = spark.createDataFrame(rows, "conv_id bigint, seq bigint, role string, tool_name string, segment string")
    letters = lambda text: F.filter(F.split(text, ""), lambda t: t != "")
    placed = training.positioned(training.measure(segments, letters))
    got = sorted(map(tuple, training.find_in_conversations(placed, needle, letters).collect()), key=repr)
    n = len(needle)
    want = [(c, i) for c, tokens_ in whole.items() for i in range(len(tokens_) - n + 1) if n and tokens_[i : i + n] == needle]
    assert got == sorted(want, key=repr)


def test_overlapping_subsequences(spark):
    rows = spark.createDataFrame([(["1", "1", "1"],), (["1"],)], "tokens array<string>")
    found = training.find_subsequence(rows, ["1", "1"], "tokens").collect()
    assert [r.starts for r in found] == [[0, 1], []]


def test_json_call_needs_exact_spacing(spark):
    rows = spark.createDataFrame([(1, "json_extract(METADATA,'$.x') json_extract(METADATA, '$.y')")], "id int, t string")
    assert [tuple(r) for r in training.json_extract_spans(rows, "id", "t").collect()] == [(1, 29, 58)]
    assert [(r.start_char, r.end_char) for r in training.find_spans(rows, "id", "t", "$.").orderBy("start_char").collect()] == [
        (23, 25), (53, 55)
    ]


def test_running_totals_do_not_depend_on_block_size(spark):
    rows = spark.range(400).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"), (F.col("id") % 7).alias("x"))
    results = []
    for size in (5, 64, 4096):
        blocked = rows.withColumn("b", F.floor(F.col("seq") / size))
        done = running_before(blocked, ["k"], ["b"], ["seq"], {"s": ("sum", "x"), "m": ("max", "x")}, {"top": ("max", "x")})
        results.append(sorted(tuple(r) for r in done.drop("b").collect()))
    assert results[0] == results[1] == results[2]
    ids = {}
    for k, seq, x, s, m, top in results[0]:
        seen = ids.setdefault(k, [])
        assert s == sum(seen) and m == (max(seen) if seen else None) and top == 6
        seen.append(x)


def test_long_conversations_continue_in_blocks(spark):
    rows = [(1, i, i, "user", f"m{i}", None, None, True, True) for i in range(10)]
    nested = conversations.implode_messages(spark.createDataFrame(rows, SCHEMA), 4).orderBy("block_no").collect()
    assert [len(r.messages) for r in nested] == [4, 4, 2]
    assert [m.content for r in nested for m in r.messages] == [f"m{i}" for i in range(10)]
    back = conversations.explode_messages(conversations.implode_messages(spark.createDataFrame(rows, SCHEMA), 4))
    assert sorted(tuple(r) for r in back.collect()) == [(1, i, "user", f"m{i}") for i in range(10)]


def test_parts_of_one_result_become_one_message(spark):
    rows = [(1, 0, 0, "user", "q", None, None, True, True), (1, 1, 1, "tool", "[1,", None, None, True, False)]
    rows += [(1, 2, 1, "tool", " 2,", None, None, False, False), (1, 3, 1, "tool", " 3]", None, None, False, True), (1, 4, 2, "assistant", None, "t", "{}", True, True)]
    nested = conversations.implode_messages(spark.createDataFrame(rows, SCHEMA), 2).orderBy("block_no").collect()
    assert [[(m.turn, m.role, m.content, m.tool_name) for m in r.messages] for r in nested] == [
        [(0, "user", "q", None), (1, "tool", "[1, 2, 3]", None)], [(2, "assistant", None, "t")]
    ]


def test_running_totals_keep_rows_with_null_keys(spark):
    rows = spark.createDataFrame([(None, 0, 1, 5), ("a", None, 1, 6), ("a", 0, 1, 7), ("a", 0, 2, 8)], "k string, b int, seq int, x int")
    done = running_before(rows, ["k"], ["b"], ["seq"], {"s": ("sum", "x")}, {"top": ("max", "x")})
    assert sorted((r.x, r.s, r.top) for r in done.collect()) == [(5, 0, 5), (6, 0, 8), (7, 6, 8), (8, 13, 8)]


def test_everything_is_chosen_with_certainty(spark):
    from eventloom.functions.sampling import below_probability

    assert spark.range(1000).where(below_probability(1, F.col("id").cast("string"), 1.0)).count() == 1000
    assert spark.range(1000).where(below_probability(1, F.col("id").cast("string"), 0.0)).count() == 0


@pytest.mark.parametrize("side", ["right", "left"])
def test_padding(spark, side):
    rows = spark.createDataFrame(
        [(1, [5, 6], [5, -100], [1.0, 0.0]), (2, [7], [7], [2.0])],
        "conv_id int, input_ids array<int>, labels array<int>, loss_weights array<double>",
    )
    padded = {r.conv_id: r for r in training.pad_batches(rows, 2, side, 0).collect()}
    assert padded[1].input_ids == [5, 6] and padded[1].attention_mask == [1, 1]
    two = padded[2]
    expected = ([7, 0], [1, 0], [7, -100], [2.0, 0.0])
    if side == "left":
        expected = tuple(list(reversed(e)) for e in expected)
    assert (two.input_ids, two.attention_mask, two.labels, two.loss_weights) == expected


def test_split_is_disjoint_and_about_a_tenth(spark):
    rows = training.train_test_split(spark.range(20000), "id")
    counts = {r.split: r["count"] for r in rows.groupBy("split").count().collect()}
    assert counts["train"] + counts["test"] == 20000 and 1700 < counts["test"] < 2300


@pytest.mark.parametrize("piece", [1, 7, 50, 8192])
def test_pieces_join_to_the_whole_arrays(spark, piece):
    segments = conversations.render_segments(spark.createDataFrame(random_messages(11, 40), SCHEMA))
    weighted = training.loss_weights(training.positioned(training.measure(segments)))
    whole = {r.conv_id: r for r in training.examples(weighted, piece_tokens=10**6).collect()}
    joined: dict = {}
    for r in sorted(training.examples(weighted, piece_tokens=piece).collect(), key=lambda r: (r.conv_id, r.piece)):
        assert 0 < len(r.input_ids) <= piece and len(r.input_ids) == len(r.labels) == len(r.loss_weights)
        assert r.example_id == (str(r.conv_id) if r.piece == 0 else f"{r.conv_id}:{r.piece}")
        for name in ("input_ids", "labels", "loss_weights"):
            joined.setdefault((r.conv_id, name), []).extend(r[name])
    assert {c for c, _ in joined} == set(whole)
    assert all(joined[c, name] == whole[c][name] for c in whole for name in ("input_ids", "labels", "loss_weights"))


def test_batches_stay_within_the_token_budget(spark):
    draw = random.Random(4)
    rows = [(str(i), [1] * n, [2] * n, [1.0] * n) for i, n in enumerate([draw.choice([3, 3, 3, draw.randint(1, 90)]) for _ in range(400)] + [500])]
    frame = spark.createDataFrame(rows, "example_id string, input_ids array<int>, labels array<int>, loss_weights array<double>")
    batches: dict = {}
    for r in training.budget_batches(frame, budget=200, step=8).collect():
        assert len(r.input_ids) == len(r.attention_mask) == len(r.labels) == len(r.loss_weights) == r.width and r.width % 8 == 0
        assert sum(r.attention_mask) == len(rows[int(r.example_id)][1]) > r.width - 8
        batches.setdefault((r.width, r.batch_no), []).append(r.example_id)
    assert sorted(x for b in batches.values() for x in b) == sorted(r[0] for r in rows)
    for (width, _), members in batches.items():
        assert len(members) * width <= 200 or len(members) == 1
    full = [w for w, _ in batches]
    # All batches of a width but its last one are full.
    for w in set(full):
        sizes = [len(m) for (width, no), m in sorted(batches.items()) if width == w]
        assert all(s == max(1, 200 // w) for s in sizes[:-1])


@pytest.mark.parametrize("tokenizer", [tokens, by_threes], ids=["words", "threes"])
def test_weights_of_shared_and_left_out_texts(spark, tokenizer):
    """Texts measured once, and tokens left out until they are needed, give the same weights as all of it; in joined tokens too."""
    texts = random_messages(11, 60)
    texts += [(100 + i, 0, 0, "assistant", t, vocab.SQL_TOOL, "{}", True, True) for i, t in enumerate(["$.a json_extract(METADATA, '$.b')", "json_extract(METADATA, '$.a", "\x00$.", "$.$.", ""])]
    texts += [(101, 1, 1, "assistant", "still in the call", None, None, True, True), (101, 2, 2, "tool", "end)", None, None, True, True)]
    segments = conversations.render_segments(spark.createDataFrame(texts, SCHEMA))
    measured = training.measure(segments, tokenizer, shared=segments.where("conv_id % 3 = 0 OR role = 'tool'").select("segment"))
    some = training.loss_weights(training.positioned(training.without_plain_pieces(measured)), None, tokenizer)
    for row in some.select("conv_id", "seq", "segment", training.flags().alias("y"), training.all_weights().alias("w")).collect():
        assert len(row.y) == len(row.w) and [w > 0 for w in row.w] == row.y
    key = ["conv_id", "seq", training.flags().alias("y"), training.all_weights().alias("w")]
    # The same by token ends: what is cut at a limit no message reaches is searched in its characters.
    by_ends = training.measure(segments, tokenizer).withColumn("answer_at", F.lit(None).cast("int"))
    slow = training.loss_weights(training.positioned(by_ends), None, tokenizer).select(key)
    assert sorted(some.select(key).collect(), key=str) == sorted(slow.collect(), key=str)


def test_few_values_are_counted_as_all_are(spark):
    rows = [(1, 4, [0.0, 1.0, 20.0, 2.0]), (1, 2, None), (1, 3, [1.5, 1.5, 0.0]), (2, 1, None), (3, 2, [0.0, 0.0])]
    got = training.weight_stats(spark.createDataFrame(rows, "conv_id int, n_kept int, weights array<double>")).orderBy("conv_id").collect()
    assert [tuple(r) for r in got] == [(1, 9, 4, 20.0, 5.2), (2, 1, 0, 0.0, None), (3, 2, 0, 0.0, None)]
