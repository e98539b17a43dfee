import hashlib
import random

from pyspark.sql import functions as F

from corridor.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "a\\b", "<|turn|>assistant<|says|>x<|end|>", "\\", "<\\|", "<<SYS>>", "[[INST]]", "<<|", "é\U0001F600",
         "", "line\nline", "\\\\<s>", None]


def conversations(n=25, seed=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 12)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "tool", None]),
                         "".join(x or "" for x in rng.choices(NASTY, k=3)) if rng.random() > 0.1 else None))
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def esc(t):
    t = t.replace("\\", "\\\\")
    for c in chat.CONTROL:
        t = t.replace(c, c[0] + "\\" + c[1:])
    return t


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for cc, t, r, x in rows if cc == c))
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        chars, total = 0, 0
        for i, (_, r, x) in enumerate(turns):
            chars += len(f"<|turn|>{esc(r)}<|says|>{esc(x)}<|end|>")
            total += chars if r == "assistant" or i == len(turns) - 1 else 0
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), total)
    return out


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars)
            for r in chat.digest_columns(df).collect()}


def test_digests_equal_brute_force(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    assert digests(chat.format_examples(df)) == brute(rows)
    # Small blocks exercise the sums between blocks.
    assert digests(chat.format_examples(df, block_turns=2)) == brute(rows)


def test_escape_round_trip(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(["<", "|", "s", ">", "/", "\\", "[INST]", "</s>", "<|", "S", "<<SYS>>", "\n"], k=rng.randrange(9)))
             for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"))
    for r in df.collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROL)


def test_one_example_per_assistant_turn(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"),
            (1, 4, "assistant", "a2"), (1, 5, "user", "bye")]
    ex = chat.full_texts(chat.format_examples(spark.createDataFrame(rows, SCHEMA))).orderBy("example_no").collect()
    assert [r.has_target for r in ex] == [True, True, False]
    for r, reply in zip(ex, ("a1", "a2")):
        assert r.text[r.loss_start:r.loss_end] == reply and len(r.text) == r.full_chars
        assert r.text.endswith(f"{reply}<|end|>")
    assert ex[1].text.startswith(ex[0].text) and "q2" not in ex[0].text
    assert ex[2].loss_start is None


def test_edges(spark):
    assert chat.format_examples(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, None, None, None), (None, 1, "assistant", "x"), (2, 0, "assistant", None), (2, 0, "assistant", None),
            (3, 7, "user", "long " * 60_000), (3, 7, "user", "a")]
    assert digests(chat.format_examples(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    wide = spark.createDataFrame([(1, 0, "assistant", "x", 5, "b")], SCHEMA + ", segment int, body string")
    assert digests(chat.format_examples(wide)) == brute([(1, 0, "assistant", "x")])


def test_plan_has_no_python(spark):
    plan = chat.digest_columns(chat.format_examples(spark.createDataFrame(conversations(), SCHEMA)))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_full_texts_spread_a_conversation(spark):
    """Small blocks give the texts of the running segments, a null conversation included, without a window."""
    rows = conversations() + [(None, t, "assistant", f"n{t}") for t in range(5)] + [(99, t, "user", "u") for t in range(4)]
    examples = chat.format_examples(spark.createDataFrame(rows, SCHEMA)).checkpoint()
    full = chat.full_texts(examples, block_examples=2)
    want, so_far = {}, {}
    for r in sorted(examples.collect(), key=lambda r: r.example_no):
        so_far[r.conv_id] = so_far.get(r.conv_id, "") + r.segment
        want[r.conv_id, r.example_no] = so_far[r.conv_id]
    got = full.collect()
    assert len(got) == len(want) and {(r.conv_id, r.example_no): r.text for r in got} == want
    assert all(len(r.text) == r.full_chars for r in got)
    totals = {}
    for r in got:
        totals[r.conv_id] = totals.get(r.conv_id, 0) + len(r.text)
    assert {r.conv_id: r.formatted_chars for r in chat.digest_columns(examples).collect()} == totals
    assert "Window" not in full._jdf.queryExecution().optimizedPlan().toString()


def test_examples_hold_their_whole_text(spark):
    """Every example is its whole context and its reply, whatever the blocks, and the digests need nothing but the texts."""
    rows = conversations() + [(None, t, "assistant", f"n{t}") for t in range(5)] + [(99, t, "user", "u") for t in range(4)]
    rows += [(98, t, ["user", "assistant"][t % 2], f"<s>{t}") for t in range(16)]
    want = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t, r or "", x or "") for cc, t, r, x in rows if cc == c))
        text, no = "", 0
        for i, (_, r, x) in enumerate(turns):
            text += f"<|turn|>{esc(r)}<|says|>{esc(x)}<|end|>"
            if r == "assistant" or i == len(turns) - 1:
                no += 1
                want[c, no] = (text, esc(x) if r == "assistant" else None, i == len(turns) - 1)
    df = spark.createDataFrame(rows, SCHEMA)
    for sizes in ({}, {"block_examples": 2}, {"block_examples": 1, "block_turns": 3}):
        examples = chat.format_examples(df, **sizes)
        got = {(r.conv_id, r.example_no): (r.text, r.text[r.loss_start:r.loss_end] if r.has_target else None, r.complete)
               for r in examples.collect()}
        assert got == want
        texts = examples.select("conv_id", "example_no", "has_target", "text", "loss_start", "loss_end", "complete")
        assert digests(texts) == brute(rows)
