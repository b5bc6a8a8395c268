"""New words are learned without the offsets of their tokens, and any text has the ids that the library gives it."""

import pytest

from cellspark.llm.common import tokenizer_file
from cellspark.llm.packing import Words

TEXTS = ["", " ", "plain words, plain words.", "ÉCOLE Straße ÆON", "İstanbul ΣΑΣ Ǆ", "a<|startoftext|>b <|endoftext|>", "<| x |>",
         "x\x1cy\x85z", "été", "100 % #tag *bold* a|b", "中文 текст emoji 😀!", "ﬁne KK"]


class WithoutOffsets:
    def __init__(self, tokenizer):
        self.encode_batch_fast = tokenizer.encode_batch_fast


def test_ids_are_those_of_the_library():
    words = Words(tokenizer_file("word_bpe_49k.json"))
    wanted = [words.direct(t) for t in TEXTS]
    assert words.encode(TEXTS) == wanted
    assert words.encode(TEXTS[::-1]) == wanted[::-1]


@pytest.mark.parametrize("text", ["some new words", "größe, maß."])
def test_new_words_need_no_offsets(text):
    words = Words(tokenizer_file("word_bpe_49k.json"))
    wanted = words.direct(text)
    words.tokenizer = WithoutOffsets(words.tokenizer)
    assert words.encode([text]) == [wanted]
