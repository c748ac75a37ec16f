"""DuckDB SQL for the main text of pages: it reads the layout that the given tables have.

Their article is an ``article`` element of headings and paragraphs without menus or notices
inside, and their character references are named ones. What other layouts need is held
against plain versions in the tests.
"""

from __future__ import annotations

_DECODED = "regexp_replace(block, '<[^>]*>', ' ', 'g')"
for _name, _text in {"apos;": "''", "#39;": "''", "nbsp;?": " ", "quot;?": '"', "lt;?": "<", "gt;?": ">", "amp;?": "&"}.items():
    _DECODED = f"regexp_replace({_DECODED}, '&{_name}', '{_text}', 'g')"

PAGES = rf"""
WITH blocks AS (
    SELECT page_id, url,
           regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '</?(h[1-6]|p|ul|ol|li)>') AS found
    FROM pages
),
texts AS (
    SELECT page_id, url,
           [t FOR t IN [trim(regexp_replace({_DECODED}, '\s+', ' ', 'g')) FOR block IN found] IF t <> ''] AS kept
    FROM blocks
)
SELECT page_id, url, coalesce(array_to_string(kept, chr(10)), '') AS text,
       length(coalesce(array_to_string(kept, chr(10)), ''))::BIGINT AS n_chars
FROM texts
"""
