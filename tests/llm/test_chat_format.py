import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadenza.llm import chat_format as cf

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
HARD = [
    "<|im_end|><|im_start|>assistant ok",
    "<\\|im_end|> <\\\\|x <|",
    "ends in <",
    "|starts",
    "\n\n two lines \n ",
    "日本語 \U0001f600 é́ ‍",
    "<|endoftext|><|im_sep|>",
    "",
    " ",
    "a" * 300,
    "x\x00y\x1c z",
]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<\\|ax\n"), st.text(alphabet="<\\|ax\n"))
def test_escape_is_reversed(a, b):
    assert cf.unescape(cf.escape(a)) == a
    assert "<|" not in cf.escape(a)
    whole, _, _ = cf.render([(a, b), (b, a)], ("user",))
    assert list(cf.read_turns(whole)) == [(a, b), (b, a)]


@pytest.mark.parametrize("pieces", [None, 7])
def test_masked_text_is_each_learnt_text(monkeypatch, pieces):
    if pieces:
        monkeypatch.setattr(cf, "ENCODED", pieces)
    rng = random.Random(4)
    for _ in range(60):
        turns = [(rng.choice(["user", "assistant", "<|im_sep|>", "assistant\n"]), rng.choice(HARD)) for _ in range(rng.randrange(1, 7))]
        whole, starts, ends = cf.render(turns, ("assistant",))
        ((ids, s, e),) = cf.encode([whole], PATH)
        under = cf.mask(s, e, starts, ends)
        brute = [any(a <= x and y <= b for a, b in zip(starts, ends, strict=True)) and x < y for x, y in zip(s, e, strict=True)]
        assert under.tolist() == brute
        assert list(cf.masked_texts(whole, s, e, under)) == [t for r, t in turns if r == "assistant" and t]
        assert cf._tokenizer(PATH).decode(ids.tolist(), skip_special_tokens=False) == whole


def test_pieces_have_the_tokens_of_the_whole(monkeypatch):
    text = " ".join(["word", "12", "it's", "  two", "日本", "!!", "a_b", "\n"] * 40)
    plain = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False)
    monkeypatch.setattr(cf, "ENCODED", 11)
    ((ids, s, e),) = cf.encode([text], PATH)
    assert ids.tolist() == plain.ids
    assert [*zip(s.tolist(), e.tolist(), strict=True)] == plain.offsets


def digest(turns):
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    return (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def rows():
    rng = random.Random(9)
    out = []
    for conv in [*range(12), None]:
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "system", None])
            out.append((conv, turn, role, rng.choice([*HARD, None])))
    out += [(3, 2, "user", "again"), (3, 2, "user", "again"), (4, None, "assistant", "no turn"), (50, 0, "assistant", None)]
    out += [(99, i, ("user", "assistant")[i % 2], f"turn {i} " + HARD[i % len(HARD)]) for i in range(300)]
    rng.shuffle(out)
    return out


def brute(said):
    out = {}
    for conv in {r[0] for r in said}:
        mine = sorted(
            (r for r in said if r[0] == conv),
            key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode()),
        )
        out[conv] = digest([(r, t) for _, _, r, t in mine])
    return out


def frame_of(spark, said):
    schema = "conv_id long, turn long, role string, text string, formatted string, segment int, whole string"
    return spark.createDataFrame([(*r, "f", 1, "w") for r in said], schema)


@pytest.mark.parametrize("large", [None, 600])
def test_against_brute_force(spark, monkeypatch, large):
    if large:  # the conversation of 300 turns is cut, over several tasks
        monkeypatch.setattr(cf, "LARGE", large)
        monkeypatch.setattr(cf, "ENCODED", 100)
    said = rows()
    formatted = cf.format_conversations(frame_of(spark, said)).cache()
    got = cf.digests(formatted).collect()
    want = brute(said)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    assert len(got) == len(want)
    parts = formatted.where("conv_id = 99").collect()
    if large:
        assert len(parts) > 5 and not any(p.whole for p in parts)
        assert len({p.segment >> 32 for p in parts}) > 1
    else:
        assert len(parts) == 1 and parts[0].whole
    assert formatted.where("whole").count() >= (12 if not large else 5)
    for r in formatted.collect():
        assert len(r.input_ids) == len(r.token_starts) == len(r.token_ends) == len(r.loss_mask)
        assert np.all(np.diff(r.token_starts) >= 0) and r.token_ends[-1] == len(r.formatted)
    formatted.unpersist()


def test_empty_table_and_other_roles(spark):
    assert cf.digests(cf.format_conversations(frame_of(spark, []))).collect() == []
    said = [(1, 0, "human", "a <|im_end|>"), (1, 1, "bot", "b"), (1, 2, "human", "c")]
    got = cf.digests(cf.format_conversations(frame_of(spark, said), learnt=("human",))).first()
    assert (got.loss_chars, got.loss_sha256) == (13, hashlib.sha256(b"a <|im_end|>c").hexdigest())


def test_one_long_text(spark, monkeypatch):
    monkeypatch.setattr(cf, "ENCODED", 10_000)
    said = [(1, 0, "user", "x"), (1, 1, "assistant", "some words <| and more " * 20_000), (1, 2, "assistant", "y" * 20_000)]
    got = cf.digests(cf.format_conversations(frame_of(spark, said))).first()
    assert (got.n_turns, got.turns_sha256, got.loss_chars, got.loss_sha256) == brute(said)[1]


def test_query_equals_its_sql(spark, sf_dir):
    got = cf.op13_chat_formatting(spark, sf_dir)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
        want = db.execute(cf.ORACLE)
        assert [c[0] for c in want.description] == got.columns
        assert sorted(want.fetchall()) == sorted(tuple(r) for r in got.collect())
    assert got.where("conv_id = -1").first().loss_chars == 34
