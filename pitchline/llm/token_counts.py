"""Exact token counts at every prefix of a text, by dynamic programming.

For a byte-pair vocabulary every prefix of a piece of text has one last token, and the prefix before that token ends in
a token with which it is compatible: merging the two alone gives the same two. So the table of a prefix follows from
shorter ones (``count[i] = count[i - len(last[i])] + 1``), and truncation or budget questions are look-ups.

No vocabulary entry holds a blank after another character, or one of certain marks (found from the vocabulary) after a
letter, and a line feed is never merged. So tables are made for each piece between such places, kept for pieces that
repeat (up to a bound a worker), and added up along the text.

Cases: null is empty and has no tokens. Long texts without blanks take linear time. Rows that repeat are counted each.
An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.common import batch_rows, read_table

LIMIT = 4096
KEPT_PIECES = 800_000  # tables a worker keeps
KEPT_LENGTH = 64  # characters of the longest piece whose table is kept
BLANK = "▁"
_LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PrefixCounter:
    """Token counts of all prefixes of a text for one vocabulary of merges with byte fallback."""

    def __init__(self, model: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = library.get_piece_size()
        usual = [i for i in range(size) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))]
        self.score = {library.id_to_piece(i): library.get_score(i) for i in usual}
        odd = [p for p in self.score if BLANK in p.lstrip(BLANK) or ("\n" in p and p != "\n")]
        if odd or library.normalize(" a\tb  ") != f"{BLANK}{BLANK}a\tb{BLANK}{BLANK}":
            raise ValueError("this vocabulary joins pieces across blanks or rewrites texts")
        after_letter = {b for p in self.score for a, b in zip(p, p[1:]) if re.match(_LETTER, a)}
        marks = re.escape("".join(m for m in _MARKS if m not in after_letter) + "\n")
        self.pieces = re.compile(f"\n|{BLANK}*{_LETTER}+(?=[{marks}])|{BLANK}*[^{BLANK}\n]+|{BLANK}+")
        self.longest = max(map(len, self.score))
        self.fits: dict[tuple[str, str], bool] = {}
        self.tables: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The tokens of a short string by merging best pairs first, leftmost of equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = score.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, before: str, last: str) -> bool:
        found = self.fits.get((before, last))
        if found is None:
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            found = self.fits[before, last] = self.merged(before + last) == ([before, last] if before else [last])
        return found

    def table(self, piece: str) -> np.ndarray:
        """Tokens of piece[:1], piece[:2], and so on."""
        count, last = [0], [""]
        score, fits, longest = self.score, self.fits, self.longest
        for end in range(1, len(piece) + 1):
            for start in range(end - 1, max(-1, end - longest - 1), -1):  # one token fits; most are short
                token = piece[start:end]
                if token in score:
                    before = last[start]
                    ok = fits.get((before, token))
                    if self.compatible(before, token) if ok is None else ok:
                        last.append(token)
                        count.append(count[start] + 1)
                        break
            else:  # not in the vocabulary: its bytes
                last.append(piece[end - 1])
                count.append(count[end - 1] + len(piece[end - 1].encode()))
        return np.array(count[1:], np.int32)

    def _kept(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = self.table(piece).tobytes()
        if len(piece) <= KEPT_LENGTH:
            if len(self.tables) >= KEPT_PIECES // 2:
                self.old, self.tables = self.tables, {}  # the older half goes
            self.tables[piece] = found
        return found

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of text[:0], text[:1], ..., text; the empty text has none, the dummy blank before others counts."""
        if not text:
            return np.zeros(1, np.int32)
        kept = self._kept
        tables = [self.tables.get(p) or kept(p) for p in self.pieces.findall(BLANK + text.replace(" ", BLANK))]
        lengths = np.fromiter(map(len, tables), np.int64, len(tables)) // 4
        counts = np.frombuffer(b"".join(tables), np.int32)
        ends = lengths.cumsum() - 1
        before = np.zeros(len(tables), np.int32)
        np.cumsum(counts[ends[:-1]], out=before[1:])
        counts = counts + np.repeat(before, lengths)
        counts[0] = 0  # the place of the dummy blank is the empty prefix
        return counts


def within(prefixes: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix that has at most ``budget`` tokens."""
    return int(np.flatnonzero(prefixes <= budget)[-1])


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model: str) -> PrefixCounter:
    if model not in _COUNTERS:
        _COUNTERS[model] = PrefixCounter(model)
    return _COUNTERS[model]


def token_counts(docs: DataFrame, limit: int = LIMIT, model: str | None = None, with_tables: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fits_chars (longest prefix within the limit).

    ``with_tables`` adds ``prefix_counts``: the counts of all prefixes as little-endian 32-bit integers, for later
    budgets without tokenizing again (``numpy.frombuffer`` and :func:`within`).
    """
    model = model or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model)
        for ids, texts in batch_rows(batches, "doc_id", "text"):
            tables = [own.prefixes(t or "") for t in texts]
            n = [int(t[-1]) for t in tables]
            columns = [pa.array(ids, pa.int64()), pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_()), pa.array([len(t) - 1 if x <= limit else within(t, limit) for t, x in zip(tables, n)], pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit", "fits_chars"]
            if with_tables:
                columns, names = [*columns, pa.array([t.tobytes() for t in tables], pa.binary())], [*names, "prefix_counts"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fits_chars long" + ", prefix_counts binary" * with_tables
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(read_table(spark, folder, "documents"))
