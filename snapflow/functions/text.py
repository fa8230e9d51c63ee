"""Text expressions. Everything here stays in JVM codegen except the header-name helper.

Trimming and blankness follow Java string rules, which differ from Spark's own ``trim``:
trimming removes every leading/trailing character up to U+0020, and blank means "only
Unicode whitespace, non-breaking spaces excluded".
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Java counts as whitespace (no non-breaking spaces).
JAVA_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                   "\u2008\u2009\u200a\u2028\u2029\u205f\u3000")
EDGE_CONTROL = r"^[\x00-\x20]+|[\x00-\x20]+$"
ONLY_WHITESPACE = r"^\p{javaWhitespace}*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jtrim(c: Column | str) -> Column:
    """Most values need no trimming: a look at both ends saves them the regular expression."""
    c = _col(c)
    padded = (F.ascii(c) <= 32) | (F.ascii(F.substring(c, -1, 1)) <= 32)
    return F.when(padded, F.regexp_replace(c, EDGE_CONTROL, "")).otherwise(c)


def is_blank(c: Column | str) -> Column:
    """True for text with no visible character; NULL stays NULL."""
    return _col(c).rlike(ONLY_WHITESPACE)


def has_text(c: Column | str) -> Column:
    """Never NULL: false for NULL and for blank text."""
    return F.coalesce(~is_blank(_col(c).cast("string")), F.lit(False))


def concat_nonblank(cols: Sequence[Column | str], separator: str = "") -> Column:
    """Join the non-blank values in order; an all-blank row gives ``''``, never NULL."""
    texts = [_col(c).cast("string") for c in cols]
    return F.concat_ws(separator, *[F.when(~is_blank(t), t) for t in texts])


def clean_attr(c: Column | str) -> Column:
    """Text after the first colon, trimmed; without a colon, the trimmed text."""
    return jtrim(F.regexp_replace(_col(c), r"(?s)^[^:]*:", ""))


def extract_cn(c: Column | str) -> Column:
    """Value of the first ``CN=`` part of a distinguished name; other text is only trimmed.

    An empty part (``CN=,OU=x``) keeps the rest of the text, as the original rule does.
    """
    c = _col(c)
    rest = F.regexp_extract(c, r"(?s)CN=(.*)$", 1)
    part = F.regexp_extract(c, r"CN=([^,]+)", 1)
    first = F.when(rest.startswith(","), rest).otherwise(part)
    return F.when(c.contains("CN="), jtrim(first)).otherwise(jtrim(c))


def item_label(name: Column | str, item_id: Column | str) -> Column:
    """``name (last path segment of id)``; NULL name or missing segment gives NULL."""
    return F.concat(_col(name), F.lit(" ("), F.regexp_substr(_col(item_id), F.lit("[^/]+$")), F.lit(")"))


def normalize_header(name: str | None) -> str | None:
    """UPPER_SNAKE form of a column header. Runs on names, on the driver; never on rows."""
    if name is None or not name.strip(JAVA_WHITESPACE):
        return None
    plain = "".join(ch for ch in unicodedata.normalize("NFD", name.strip(JAVA_WHITESPACE)) if not "̀" <= ch <= "ͯ")
    words = re.sub(r"([a-z])(?=[A-Z])", r"\1 ", plain)
    return re.sub(r"[^A-Za-z0-9]+", "_", words).strip("_").upper()
