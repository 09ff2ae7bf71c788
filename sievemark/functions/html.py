"""Plain text from HTML with column functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose content is never text, and block elements.
SILENT = ("script", "style", "noscript", "template")
BLOCK = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html"
    "|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
)
# Named entities, the ampersand last so that nothing is decoded twice.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def html_text(html: Column | str) -> Column:
    """Visible text: one line per block, single spaces inside a line."""
    text = F.col(html) if isinstance(html, str) else html
    for name in SILENT:  # each ends at its own closing tag only
        text = F.regexp_replace(text, rf"(?is)<{name}[ \t\r\n>].*?</{name}[ \t\r\n]*>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, rf"(?i)</?({BLOCK})([ \t\r\n/][^>]*)?>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    text = F.regexp_replace(text, r"[ \t\r]+", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n")
    return F.trim(text, F.lit(" \n"))
