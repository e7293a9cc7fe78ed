"""Words of the language model's base, split without a regular expression."""

import contextlib
import io
import re

from issuetrail.llm import language_model
from issuetrail.llm.common import SPACE


def test_words_end_at_the_six_blanks_only(spark):
    texts = ["", " ", "a", "  A\tb\nC\x0bd\x0ce\rf  ", "x\xa0y\u2003z\x1cw\x85v", "\n\n\u00c9A \r\n"]
    found = language_model._split(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id")
    lower = lambda word: "".join(c.lower() if c.isascii() else c for c in word)
    expected = [(i, lower(word)) for i, text in enumerate(texts) for word in re.split(SPACE, text) if word]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        found.explain()
    assert "\\x20" not in out.getvalue() and "split(replace(" in out.getvalue()
