"""Rows that the tests of the training-data operators share."""

import os

FOLDER = os.environ.get("PITCHLINE_TESTDATA", "/root/testdata/sf0.001")

ODD = [
    (0, None), (1, ""), (2, " "), (3, "one two"), (4, "one  two"), (5, "one\t\ntwo"), (6, "One two"), (7, "\n"), (8, None),
    (9, "héllo wörld 你好 😀 don't <|endoftext|> <s>"), (10, "a" * 5000), (11, "word " * 9000), (12, "one two"),
    (12, "one two"), (None, "one two"), (None, "no number"), (13, "1234567890 " * 40), (14, "?!" * 30), (14, "same number"),
]
