import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from cadenza.llm import token_counts

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))


def tokenizer_of(pieces):
    """A unigram tokenizer of the same pieces and scores, as another implementation."""
    made = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=any(p == "<0x00>" for p, _ in pieces)))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(r"[\x20\x09-\x0D]+"), "removed"),
            pre_tokenizers.Metaspace("▁", "always", split=True),
        ]
    )
    return made


@pytest.fixture(scope="module")
def pieces():
    """All pieces by id: the other implementation needs those of bytes for characters without a piece."""
    model = SentencePieceProcessor(model_file=PATH)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


@pytest.mark.parametrize("text", ["x<s>y", "a<s>b", "</s>", "x<0x41>y", "<unk>", "<unk> <s>x</s> <0x0A>"])
def test_marks_in_a_text_are_characters(text):
    own = token_counts.vocabulary(PATH)
    assert not {"<s>", "</s>", "<unk>", "<0x41>"} & {p for p, _ in own}
    plain = tokenizer_of([("<unk>", min(s for _, s in own) - 10), *own])
    counter = token_counts.Counter(own)
    words = text.split()
    assert sum(counter[w][0] for w in words) == len(plain.encode(text).ids)


def test_query_is_the_tokenizers_count(spark, sf_dir, pieces):
    made = tokenizer_of(pieces)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = token_counts.op10_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(made.encode(t).ids) if t else 0 for i, t in texts.items()}


def every_path(text, scores, unknown):
    """Best score over all segmentations, by brute force."""
    if not text:
        return 0.0
    found = [scores[text[:k]] + every_path(text[k:], scores, unknown) for k in range(1, len(text) + 1) if text[:k] in scores]
    if text[0] not in scores:
        found.append(unknown + every_path(text[1:], scores, unknown))
    return max(found)


@pytest.mark.parametrize("seed", range(40))
def test_small_vocabularies_with_ties(seed):
    rng = random.Random(seed)
    letters = "ab▁" if seed % 2 else "abc▁"
    own = {"<unk>": 0.0}
    for _ in range(rng.randint(1, 14)):
        own["".join(rng.choices(letters, k=rng.randint(1, 4)))] = float(-rng.randint(1, 4))
    counter = token_counts.Counter(list(own.items()))
    made = tokenizer_of(list(own.items()))
    for _ in range(40):
        word = "".join(rng.choices("abc", k=rng.randint(1, 9)))
        n, score = counter[word]
        scores = {k: v for k, v in own.items() if k != "<unk>"}
        assert score == pytest.approx(every_path("▁" + word, scores, counter.unknown))
        if all(c in own for c in "▁" + word):  # with unknown characters that tokenizer joins them to one token
            assert n == len(made.encode(word).ids)


def test_edges(spark, frame, pieces):
    made = tokenizer_of(pieces)
    texts = [None, "", " \t\n ", "the the", "日本語 𝄞𝄞 x\x00y", "a\x85b\xa0c\x1cd", "<0x41> <s> </s>", "z" * 40000]
    docs = frame([(i, t, None, None) for i, t in enumerate(texts)] + [(3, "the the", None, None), (None, "of", None, None)])
    got = token_counts.token_counts(docs, PATH).collect()
    want = [(i, len(made.encode(t).ids) if t else 0) for i, t in [*enumerate(texts), (3, "the the"), (None, "of")]]
    key = lambda x: (x[0] is None, x)
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=key) == sorted(want, key=key)
    assert {r.best_score for r in got if r.doc_id in (0, 1, 2)} == {0.0}
    assert token_counts.token_counts(frame([]), PATH).collect() == []
