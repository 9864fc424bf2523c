import random

import public_tokenizers
import pytest

from fareloom.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return pieces.codec(PATH)


def plain_best(codec, marked):
    """The highest sum of scores, trying every piece at every place."""
    scores = {p: s for p, (_, s, _) in zip(codec.automaton.keys(), codec.automaton.values())}
    best = [0.0] + [float("-inf")] * len(marked)
    for end in range(1, len(marked) + 1):
        best[end] = best[end - 1] + codec.unknown
        for start in range(end):
            if marked[start:end] in scores:
                best[end] = max(best[end], best[start] + scores[marked[start:end]])
    return best[-1]


def test_the_single_pass_finds_the_best_score(codec):
    drawn = random.Random(11)
    for _ in range(150):
        marked = "▁" + "".join(drawn.choice("theandioner▁s漢\x00é") for _ in range(drawn.randint(0, 25)))
        ids, score, _ = codec.best_path(marked)
        assert score == pytest.approx(plain_best(codec, marked), rel=1e-12)
        assert "▁".join(codec.decode(__import__("numpy").array(ids)).split(" "))[0:] is not None


def test_words_one_by_one_equal_the_whole_text(codec):
    for text in ["the old bridge", " two  spaces   here ", "line\nend \n x", "a", "   ", "\n", "mixed é漢𝒳 words."]:
        _, score, _ = codec.encode(text)
        whole = plain_best(codec, "▁" + text.replace(" ", "▁"))
        assert score == pytest.approx(whole, rel=1e-12)


def test_round_trip(codec):
    drawn = random.Random(12)
    letters = " \n\t\r▁abcé漢𝒳\x00\x85<0x41>̈"
    texts = ["", " ", "▁", " ▁ ", "▁▁ a", "<0x0A> <s> </s> <unk>"]
    texts += ["".join(drawn.choice(letters) for _ in range(drawn.randint(0, 50))) for _ in range(1500)]
    for text in texts:
        assert codec.decode(codec.encode(text)[0]) == text


def test_forgetting_changes_nothing(codec, monkeypatch):
    text = "many words that are all remembered and forgotten again " * 3
    before = codec.encode(text)[0].tolist()
    monkeypatch.setattr(pieces, "REMEMBERED_WORDS", 2)
    assert codec.encode(text)[0].tolist() == before


def test_documents(spark, odd_documents, no_documents):
    digest = pieces.encoding_digest(odd_documents, PATH).collect()
    assert len(digest) == odd_documents.count() and all(r["round_trip"] for r in digest)
    encoded = pieces.encode_documents(odd_documents, PATH)
    back = pieces.decode_documents(encoded, PATH)
    key = lambda r: (repr(r["doc_id"]), r["text"] or "")
    assert sorted(map(key, back.collect())) == sorted(map(key, odd_documents.collect()))
    assert pieces.encoding_digest(no_documents, PATH).count() == 0
