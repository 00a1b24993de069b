"""Disguised words that the decoder restores, and plain texts that it leaves alone."""

import numpy as np
import pytest

WORDS = "you are an idiot asshole dumbass class glass kiss come whore stupid people of this house and that street with other words"


@pytest.fixture(scope="module")
def restorer():
    from seriesmart.llm import toxicity as x
    total = np.full((27, 27, 27), 0.1)
    code = x._code(" " + " ".join([WORDS] * 300) + " ")
    np.add.at(total, (code[:-2], code[1:-1], code[2:]), 1)
    two = total.sum(axis=0)
    two = (two + 0.1) / (two + 0.1).sum(axis=1, keepdims=True)
    return x.Restorer(np.log((total + 5 * two[None]) / (total.sum(axis=2, keepdims=True) + 5)))


@pytest.mark.parametrize("text,word", [
    ("a$$", "ass"), ("dumba$$", "dumbass"), ("ki$$!", "kiss"), ("a s s", "ass"), ("a.s.s", "ass"), ("A S S", "ass"), ("id-iot", "idiot"),
    ("i d iot", "idiot"), ("idi o t", "idiot"), ("ass.hole", "asshole"), ("id_iot", "idiot"), ("1d10t", "idiot"), ("4$$h0l3", "asshole"),
    ("[1d10t]", "idiot"), ("id" + "1" * 40 + "ot", "idiot"), ("i.d.i.o.t", "idiot"), ("wh0re", "whore"), ("stuuuuuupid", "stupid")])
def test_restored(restorer, text, word):
    assert word in restorer.words(f"well {text} then")


@pytest.mark.parametrize("text", ["this house and that street", "price 100 or 2500", "in 1999, 2001", "one - two", "word. Word", "a-1"])
def test_plain_texts_stay(restorer, text):
    found = restorer.words(text) - set(text.lower().replace(",", " ").replace("-", " ").replace(".", " ").split())
    assert not found & set(WORDS.split())
