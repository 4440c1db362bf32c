"""Line dedup: windows of three consecutive lines, hashed and matched globally.

Lines end with a newline.  A window is three lines that follow each other when
lines of white space only are skipped, so paragraphs of one line with blank
lines between them have windows too; its key is these lines without surrounding
white space.  Every later occurrence of a window loses its lines: positions
covered by any of them are merged and cut out, wherever they overlap, with the
blank lines between covered lines; other blank lines stay.  The first
occurrence (smallest id, then text key, then line) keeps its lines, also where
a later one in the same document overlaps it.

Defined results: null and empty texts and texts under three non-blank lines stay as they
are (null stays null); rows that agree in id and text count as one document and
get the same result; rows without id come after all others; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.llm.runs import Cutter, Runs, hasher_of, remover_of, with_text, without_repeats

LINES = 3


def line_offsets(text: str) -> list[int]:
    at = [0]
    while (k := text.find("\n", at[-1])) >= 0:
        at.append(k + 1)
    return at if at[-1] == len(text) else [*at, len(text)]


def line_windows(text: str) -> Runs:
    at = line_offsets(text)
    lines = [(i, line) for i, (a, b) in enumerate(zip(at, at[1:])) if (line := text[a:b].strip())]
    windows = [lines[k:k + LINES] for k in range(len(lines) - LINES + 1)]
    return Runs(["\n".join(line for _, line in w) for w in windows], [w[0][0] for w in windows], [w[-1][0] - w[0][0] + 1 for w in windows])


CUTTER = Cutter(line_offsets, line_windows)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row: payload, id, text without repeated lines, spans cut out (characters), n_removed (lines)."""
    return without_repeats(docs, hasher_of(CUTTER), remover_of(CUTTER), id_col, text_col, spare_first=True)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The rows with the columns of ``docs``."""
    return with_text(line_dedup(docs, id_col, text_col), docs.columns, text_col, chars_col)
