"""Merging many words of one length at once gives the same ids as merging them one by one."""

import random

import pytest

from opsloom.llm import catalog, pieces


def words_of(length: int, count: int) -> list[str]:
    draw = random.Random(length)
    letters = "etaoin shrdlu0123456789ééß中ж😀\x00�".replace(" ", "")
    return ["▁" + "".join(draw.choice(letters) for _ in range(length - 1)) for _ in range(count)]


def fresh() -> pieces.MergeVocabulary:
    return pieces.MergeVocabulary(catalog.tokenizer_file("piece_bpe_32k.model"))


@pytest.mark.parametrize("length", [2, 3, 7, 20, pieces.LISTED_CHARACTERS])
def test_words_merged_together_equal_words_merged_alone(length):
    vocabulary = fresh()
    words = [*words_of(length, 300), "▁" + "a" * (length - 1)]
    vocabulary._code_together(words, length)
    assert vocabulary._coded == {w: vocabulary._code(w) for w in words}


def test_equal_scores_merge_from_the_left():
    vocabulary = fresh()
    # All pieces of one score: only the place decides.
    vocabulary._ranks = dict.fromkeys(vocabulary._ranks, -1.0)
    vocabulary._number_merges()
    words = words_of(9, 300)
    vocabulary._code_together(words, 9)
    assert vocabulary._coded == {w: vocabulary._code(w) for w in words}


def test_few_and_many_new_words_of_one_length():
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_proto=catalog.tokenizer_file("piece_bpe_32k.model"))
    texts = [" ".join(w[1:] for length in (2, 5, 6) for w in words_of(length, n)) for n in (1, pieces.TOGETHER - 1, 200)]
    for text, ids in zip(texts, fresh().encode(texts), strict=True):
        assert list(memoryview(ids).cast("i")) == library.encode(text)
