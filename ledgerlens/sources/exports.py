"""Report files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import config as C

BYTE_ORDER_MARK = "\ufeff"
# How spreadsheets write and read cells.
CSV_RULES = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def export_csv_bom(df: DataFrame, path: str, columns: Sequence[str] = C.EXPLORER_COLUMNS) -> None:
    """Chosen columns as UTF-8 CSV that spreadsheets recognise by the byte-order mark.

    The mark leads the header line, hence each part file opens correctly on its own. Quotes within a cell are doubled, and blanks
    at its ends stay.
    """
    kept = [c for c in columns if c in df.columns]
    marked = df.select(
        *[F.col(c).alias(BYTE_ORDER_MARK + c if i == 0 else c) for i, c in enumerate(kept)]
    )
    marked.write.mode("overwrite").options(header=True, encoding="UTF-8", **CSV_RULES).csv(path)
