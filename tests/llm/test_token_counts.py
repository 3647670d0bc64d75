import public_tokenizers
import pytest
from tokenizers import Tokenizer

from recordflow.llm import token_counts

from text_cases import messy_rows

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
ODD = [
    "a<|endoftext|>b <|endoftext|><|endoftext|> c", "<|endoftext|>", "<|endoftext", "it's we're I'LL  x   y \n\n z\t\t",
    "x y z\u0085w\x1c!", "𝔘𝔫𝔦 \U0001fae0 \U0001e030 ꟝ ࢏", "ՠࢎ 12٣½Ⅷ", "   ", "\n", "é ☃️ 👩‍👩‍👧",
]


@pytest.mark.parametrize("share,cache", [(token_counts.FREQUENT_SHARE, token_counts.CACHE_ENTRIES), (10, 3)])
def test_counts_equal_the_library(spark, messy, make_docs, share, cache):
    library = Tokenizer.from_file(PATH)
    docs = messy.select("doc_id", "text").union(make_docs(*ODD).select("doc_id", "text"))
    got = token_counts.count_tokens(docs, PATH, PATTERN, share=share, cache_entries=cache).collect()
    assert len(got) == len(messy_rows()) + len(ODD)
    for r in got:
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids), r.text


def test_the_table_is_bounded(make_docs):
    docs = make_docs("the cat sat on the mat", "the the the end", None, "")
    assert len(token_counts.frequent_lengths(docs, PATH, PATTERN, share=4)) <= 4


def test_empty_table(no_docs):
    assert token_counts.count_tokens(no_docs, PATH, PATTERN).count() == 0
