"""Main text of web pages: flat text blocks, classified by a decision tree on their own and their neighbours' features.

A page is read as a flat run of tags and text. Text between two block-level tags is one block; each has its number of
words, its link density (share of words inside links), those of its neighbours before and after it (of the nearest two
the longer one), and marks of where it stands: in a heading; inside an element that by tag or role is a menu, header,
footer, sidebar, form or the like, or in a list of short links, a teaser, or under a heading of readers' comments;
how far names of the elements around it (class, id) speak of such parts; inside the article, whether the page has one at
all, and whether it is a paragraph, item or cell. Of several articles those count whose text is not small beside the
longest. A small decision tree, trained on the labelled table below, keeps or drops each block. Names are a hint among the
features, not a verdict: a name of which one word is suspicious, beside others that say something else, weighs little. Scripts, styles, comments and other text that is never shown make no blocks.

Defined cases: null and empty pages give an empty text; markup may end anywhere (open tags count as open to the end, an
unclosed script or comment hides the rest); repeated pages get equal rows; a page without blocks to keep has an empty
text; pages of any length are read whole, one after the other; an empty table gives an empty result; other columns are
ignored. Pages are read one by one in Python, batch by batch of a column.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "heading", "apart", "hint", "article", "page_article", "prose")

# the labelled table: typical blocks and whether they belong to the main text
LABELLED = (
    # words, links, words_before, links_before, words_after, links_after, heading, apart, hint, article, page_article, prose, main
    # in an article: headings, paragraphs of any length, links that belong to the text
    (12, 0.0, 8, 0.0, 140, 0.0, 1, 0, 0.0, 1, 1, 1, 1),
    (4, 0.0, 60, 0.0, 12, 0.0, 1, 0, 0.0, 1, 1, 1, 1),
    (3, 1.0, 90, 0.0, 40, 0.0, 1, 0, 0.0, 1, 1, 1, 1),
    (140, 0.0, 12, 0.0, 1, 0.0, 0, 0, 0.0, 1, 1, 0, 1),
    (1, 0.0, 140, 0.0, 30, 0.0, 0, 0, 0.0, 1, 1, 1, 1),
    (30, 0.1, 1, 0.0, 9, 0.0, 0, 0, 0.0, 1, 1, 0, 1),
    (6, 1.0, 60, 0.0, 40, 0.0, 0, 0, 0.0, 1, 1, 1, 1),
    (9, 0.5, 25, 0.0, 0, 0.0, 0, 0, 0.0, 1, 1, 0, 1),
    (2, 0.0, 0, 0.0, 80, 0.0, 0, 0, 0.0, 1, 1, 1, 1),
    (300, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0.0, 1, 1, 0, 1),
    (55, 0.0, 7, 1.0, 11, 0.0, 0, 0, 0.0, 1, 1, 1, 1),
    (75, 0.0, 22, 0.0, 1, 0.0, 0, 0, 0.0, 1, 1, 0, 1),
    (3, 0.0, 2, 0.0, 4, 0.0, 0, 0, 0.0, 1, 1, 1, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, 0, 0.0, 1, 1, 0, 1),
    (5, 0.2, 9, 0.5, 7, 1.0, 0, 0, 0.0, 1, 1, 1, 1),
    (20, 0.7, 3, 0.0, 18, 0.9, 0, 0, 0.0, 1, 1, 0, 1),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0.0, 1, 1, 1, 1),
    (16, 0.0, 4, 0.0, 5, 0.0, 0, 0, 0.0, 1, 1, 0, 1),
    # in an article, with a name of which a part is suspicious
    (40, 0.0, 12, 0.0, 60, 0.0, 0, 0, 0.3, 1, 1, 1, 1),
    (7, 0.0, 12, 0.0, 30, 0.0, 0, 0, 0.25, 1, 1, 0, 1),
    (90, 0.0, 40, 0.0, 20, 0.0, 0, 0, 0.375, 1, 1, 1, 1),
    (3, 0.0, 90, 0.0, 50, 0.0, 1, 0, 0.25, 1, 1, 1, 1),
    (25, 0.1, 8, 0.0, 8, 0.0, 0, 0, 0.33, 1, 1, 1, 1),
    # comments, notices, adverts and related links in an article
    (25, 0.1, 60, 0.0, 20, 0.0, 0, 0, 1.0, 1, 1, 0, 0),
    (6, 0.8, 90, 0.0, 70, 0.0, 0, 0, 0.5, 1, 1, 1, 0),
    (120, 0.0, 80, 0.0, 90, 0.0, 0, 0, 1.0, 1, 1, 0, 0),
    (12, 0.0, 80, 0.0, 15, 0.0, 0, 0, 0.5, 1, 1, 1, 0),
    (4, 0.0, 80, 0.0, 30, 0.0, 1, 0, 1.0, 1, 1, 1, 0),
    (2, 0.0, 70, 0.0, 25, 0.0, 1, 0, 0.5, 1, 1, 1, 0),
    (40, 0.0, 70, 0.0, 35, 0.0, 0, 0, 0.5, 1, 1, 0, 0),
    (25, 0.1, 60, 0.0, 20, 0.0, 0, 1, 0.0, 1, 1, 1, 0),
    (6, 0.8, 90, 0.0, 70, 0.0, 0, 1, 0.0, 1, 1, 0, 0),
    (120, 0.0, 80, 0.0, 90, 0.0, 0, 1, 0.0, 1, 1, 1, 0),
    (3, 0.0, 80, 0.0, 90, 0.0, 1, 1, 0.0, 1, 1, 1, 0),
    # outside the article of a page that has one
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0.0, 0, 1, 1, 0),
    (2, 1.0, 1, 1.0, 8, 0.0, 0, 1, 0.0, 0, 1, 0, 0),
    (8, 0.0, 1, 1.0, 12, 0.0, 0, 0, 1.0, 0, 1, 1, 0),
    (45, 0.0, 1, 1.0, 12, 0.0, 0, 0, 1.0, 0, 1, 0, 0),
    (11, 0.0, 30, 0.0, 0, 0.0, 0, 1, 0.0, 0, 1, 1, 0),
    (70, 0.0, 200, 0.0, 0, 0.0, 0, 1, 0.0, 0, 1, 0, 0),
    (14, 0.0, 1, 1.0, 12, 0.0, 0, 0, 0.0, 0, 1, 1, 0),
    (60, 0.0, 30, 0.0, 11, 0.0, 0, 0, 0.0, 0, 1, 0, 0),
    (3, 1.0, 30, 0.0, 2, 1.0, 0, 0, 0.0, 0, 1, 1, 0),
    (150, 0.0, 90, 0.0, 100, 0.0, 0, 0, 0.0, 0, 1, 0, 0),
    (5, 0.0, 2, 0.0, 6, 0.0, 1, 0, 0.0, 0, 1, 1, 0),
    (28, 0.1, 60, 0.0, 45, 0.0, 0, 0, 0.25, 0, 1, 0, 0),
    (1, 0.0, 12, 0.0, 3, 0.0, 0, 0, 0.0, 0, 1, 1, 0),
    (80, 0.3, 5, 1.0, 60, 0.0, 0, 0, 0.0, 0, 1, 0, 0),
    # pages without an article: text of some length with few links
    (90, 0.0, 2, 1.0, 60, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (60, 0.0, 4, 0.0, 2, 0.0, 0, 0, 0.0, 0, 0, 0, 1),
    (45, 0.0, 2, 1.0, 3, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (80, 0.02, 5, 1.0, 6, 1.0, 0, 0, 0.0, 0, 0, 0, 1),
    (30, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (25, 0.1, 6, 0.0, 8, 0.0, 0, 0, 0.0, 0, 0, 0, 1),
    (150, 0.05, 1, 1.0, 1, 1.0, 0, 0, 0.0, 0, 0, 1, 1),
    (24, 0.1, 3, 1.0, 80, 0.0, 0, 0, 0.0, 0, 0, 0, 1),
    (18, 0.2, 50, 0.0, 2, 1.0, 0, 0, 0.0, 0, 0, 1, 1),
    (15, 0.0, 22, 0.0, 30, 0.1, 0, 0, 0.0, 0, 0, 0, 1),
    (40, 0.3, 2, 1.0, 3, 1.0, 0, 0, 0.0, 0, 0, 1, 1),
    (50, 0.0, 30, 0.0, 30, 0.0, 0, 0, 0.3, 0, 0, 0, 1),
    (22, 0.0, 3, 1.0, 3, 1.0, 0, 0, 0.25, 0, 0, 1, 1),
    # ... short text beside such text
    (5, 0.0, 60, 0.0, 45, 0.0, 0, 0, 0.0, 0, 0, 0, 1),
    (3, 0.0, 40, 0.0, 2, 1.0, 0, 0, 0.0, 0, 0, 1, 1),
    (1, 0.0, 30, 0.0, 28, 0.0, 0, 0, 0.0, 0, 0, 0, 1),
    (6, 0.0, 2, 1.0, 35, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (8, 0.0, 4, 0.0, 25, 0.0, 0, 0, 0.0, 0, 0, 0, 1),
    (9, 0.1, 18, 0.0, 0, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (2, 0.0, 0, 0.0, 90, 0.0, 0, 0, 0.0, 0, 0, 0, 1),
    (6, 0.0, 8, 1.0, 35, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (9, 0.0, 5, 1.0, 60, 0.0, 0, 0, 0.0, 0, 0, 0, 1),
    (4, 0.0, 12, 0.8, 40, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (12, 0.0, 3, 1.0, 20, 0.1, 0, 0, 0.0, 0, 0, 0, 1),
    (10, 0.0, 45, 0.0, 3, 1.0, 0, 0, 0.0, 0, 0, 1, 1),
    # ... headings
    (7, 0.0, 2, 1.0, 70, 0.0, 1, 0, 0.0, 0, 0, 1, 1),
    (3, 0.0, 0, 0.0, 6, 0.0, 1, 0, 0.0, 0, 0, 1, 1),
    (4, 0.0, 40, 0.0, 9, 0.0, 1, 0, 0.0, 0, 0, 1, 1),
    (2, 0.0, 2, 1.0, 5, 0.0, 1, 0, 0.2, 0, 0, 1, 1),
    # ... links, and short text that no such text is beside
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0.0, 0, 0, 0, 0),
    (4, 1.0, 60, 0.0, 3, 1.0, 0, 0, 0.0, 0, 0, 1, 0),
    (20, 0.9, 4, 1.0, 5, 1.0, 0, 0, 0.0, 0, 0, 0, 0),
    (16, 0.6, 8, 0.5, 3, 1.0, 0, 0, 0.0, 0, 0, 1, 0),
    (30, 0.8, 60, 0.0, 3, 1.0, 0, 0, 0.0, 0, 0, 0, 0),
    (3, 1.0, 2, 1.0, 70, 0.0, 0, 0, 0.0, 0, 0, 1, 0),
    (1, 1.0, 0, 0.0, 90, 0.0, 0, 0, 0.0, 0, 0, 0, 0),
    (5, 1.0, 3, 1.0, 4, 1.0, 1, 0, 0.0, 0, 0, 1, 0),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0.0, 0, 0, 0, 0),
    (6, 0.0, 4, 0.5, 0, 0.0, 0, 0, 0.0, 0, 0, 0, 0),
    (7, 0.0, 3, 1.0, 4, 0.0, 0, 0, 0.0, 0, 0, 0, 0),
    (9, 0.2, 5, 1.0, 6, 1.0, 0, 0, 0.0, 0, 0, 0, 0),
    (3, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0.0, 0, 0, 0, 0),
    (5, 0.0, 2, 1.0, 4, 0.1, 0, 0, 0.0, 0, 0, 0, 0),
    (8, 0.0, 1, 1.0, 0, 0.0, 0, 0, 0.0, 0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 4, 0.0, 0, 0, 0.0, 0, 0, 0, 0),
    (5, 0.0, 6, 0.0, 7, 0.0, 0, 0, 0.0, 0, 0, 0, 0),
    (4, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0.0, 0, 0, 0, 0),
    (2, 0.0, 9, 0.0, 0, 0.0, 0, 0, 0.0, 0, 0, 0, 0),
    (7, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0.0, 0, 0, 0, 0),
    # ... parts that stand apart, by tag or by name
    (2, 1.0, 0, 0.0, 90, 0.0, 0, 1, 0.0, 0, 0, 0, 0),
    (35, 0.0, 50, 0.0, 0, 0.0, 0, 1, 0.0, 0, 0, 1, 0),
    (80, 0.0, 90, 0.0, 60, 0.0, 0, 1, 0.0, 0, 0, 0, 0),
    (5, 0.0, 0, 0.0, 60, 0.0, 1, 1, 0.0, 0, 0, 1, 0),
    (18, 0.0, 50, 0.0, 0, 0.0, 0, 0, 0.5, 0, 0, 0, 0),
    (40, 0.0, 60, 0.0, 30, 0.0, 0, 0, 0.5, 0, 0, 1, 0),
    (80, 0.0, 90, 0.0, 60, 0.0, 0, 0, 1.0, 0, 0, 0, 0),
    (4, 0.0, 60, 0.0, 30, 0.0, 1, 0, 0.75, 0, 0, 1, 0),
    # ... short text in paragraphs, items and cells, not between links
    (2, 0.0, 1, 0.0, 2, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (2, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (3, 0.0, 2, 1.0, 4, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (5, 0.0, 6, 0.0, 7, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (9, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (7, 0.2, 4, 0.0, 9, 0.1, 0, 0, 0.0, 0, 0, 1, 1),
    (4, 0.0, 5, 0.0, 2, 1.0, 0, 0, 0.0, 0, 0, 1, 1),
    (12, 0.0, 3, 0.0, 2, 1.0, 0, 0, 0.25, 0, 0, 1, 1),
    (6, 0.0, 3, 1.0, 8, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (8, 0.0, 4, 0.0, 4, 0.0, 0, 0, 0.25, 0, 0, 1, 1),
    (1, 0.0, 8, 0.0, 0, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (14, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (11, 0.0, 0, 0.0, 6, 0.0, 0, 0, 0.0, 0, 0, 1, 1),
    (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0.0, 0, 0, 1, 0),
    (5, 0.0, 1, 1.0, 4, 1.0, 0, 0, 0.0, 0, 0, 1, 0),
    (2, 1.0, 4, 0.0, 6, 0.0, 0, 0, 0.0, 0, 0, 1, 0),
    (4, 1.0, 3, 0.0, 2, 0.0, 0, 0, 0.0, 0, 0, 1, 0),
    (6, 0.9, 3, 0.0, 5, 0.0, 0, 0, 0.0, 0, 0, 1, 0),
    (5, 0.0, 3, 0.0, 4, 0.0, 0, 0, 1.0, 0, 0, 1, 0),
    (9, 0.0, 3, 0.0, 4, 0.0, 0, 0, 0.5, 0, 0, 1, 0),
    (3, 0.0, 4, 0.0, 5, 0.0, 0, 1, 0.0, 0, 0, 1, 0),
)

# fixed values: elements of HTML by their role here
LISTS = frozenset("ul ol dl menu table".split())
PROSE = frozenset("p li td th dd dt pre blockquote figcaption caption h1 h2 h3 h4 h5 h6".split())
BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript object ol optgroup option p pre search section select summary table tbody td template textarea tfoot th thead title tr ul video audio canvas".split())
HOLDS = frozenset("a article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header iframe li main menu nav noscript object ol p pre search section select span table tbody td template th tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
APART = frozenset("aside button dialog fieldset footer form head header iframe menu nav noscript object search select template".split())
HIDDEN = frozenset("script style textarea title svg math audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog".split())
# words of names that speak of parts beside the main text: by themselves, and those that main text has in its names too
GENERIC = frozenset("a above after area areas article articles bar before below block bottom box button buttons col column container content form full global group inner item items left link links list lists main outer page panel post posts primary region right row rows secondary section sections site slot space stories story text title top unit wrap wrapper zone".split())
#: Words beside which ``header`` names the head of the text itself.
OWN = frozenset("article content entry post section story text".split())
STRONG = re.compile(r"(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|banner|cookies?|consent|gdpr|popup|modal|overlay|newsletter\w*|signup|login|sidebar|comments?|commentlist|disqus|breadcrumbs?|nav|navbar|navigation|menu|footer|masthead|copyright|pagination|pager|toolbar)")
WEAK = re.compile(r"(?:promo\w*|notices?|alerts?|subscri\w*|side|aside|rail|related|recommend\w*|share|sharing|social|respond|replies|reply|header|widgets?|skip|hidden)")
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_MARKED = re.compile(r"role|aria-hidden|style", re.I)
_NAMED = re.compile(r"class|id", re.I)
_WORD = re.compile(r"[a-z0-9]+")
#: Headings of what readers have written, and lines on rights (outside articles).
_COMMENTS = re.compile(r"(?:\d+ )?(?:(?:reader|user|visitor)s?'? )?comments?(?: ?\(?\d+\)?)?:?|\d+ (?:responses|replies|thoughts)\b.*|(?:reader|user|visitor)s?'? (?:responses|replies|discussion)|(?:leave|post|add|write) (?:a|your) (?:comment|reply)|join the (?:discussion|conversation)", re.I)
_RIGHTS = re.compile(r"(?:\u00a9|\(c\)|copyright\b)|.*\ball rights reserved\b", re.I)
#: A list is one of links if so much of it is linked, and its entries have so many words at most.
LINKED, SHORT = 0.7, 4
#: Articles count with so large a share of the unlinked words of the longest.
SHARE = 0.25
_SPACE = re.compile(r"\s+")


def _apart(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element stands apart from the main text by tag, role or style; an article's own header doesn't."""
    if tag in APART and not (tag == "header" and in_article):
        return True
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return False
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes) and not re.search(r"hidden\s*=\s*[\"']?false", attributes):
        return True
    for name, *values in _ATTRIBUTE.findall(attributes) if _MARKED.search(attributes) else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value.strip() in ROLES or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def hint(tag: str, attributes: str) -> float:
    """How far the names of an element speak of a part beside the main text: from 0 to 1.

    A name counts the mean of its words, 1 for a strong and 1/2 for a weak one, words that say nothing (list, box) left aside;
    a strong word beside others that say something counts that share twice over. Several names count halfway between the
    greatest and the mean.
    """
    if not _NAMED.search(attributes) or tag in ("html", "body", "article", "main"):
        return 0.0
    weights = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for one in "".join(values).split():
                words = _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", one).lower())
                says = [w for w in words if w not in GENERIC and not w.isdigit()]
                if says:
                    head = not OWN.isdisjoint(words)
                    known = [1.0 if STRONG.fullmatch(w) else 0.5 if WEAK.fullmatch(w) and not (head and w == "header") else 0.0 for w in says]
                    weights.append(sum(known) / len(says) * (sum(k > 0 for k in known) / len(says)))
                elif words:
                    weights.append(0.0)
    return (max(weights) + sum(weights) / len(weights)) / 2 if weights else 0.0


def blocks_of(page: str) -> tuple[list[str], np.ndarray]:
    """The texts of a page's blocks, in order, and their features."""
    texts: list[str] = []
    rows: list[tuple[int, int, bool, bool, float, int, int, int, bool]] = []
    # open holders: tag, apart, article, greatest hint so far, and the numbers of the outermost and innermost article and innermost list
    stack: list[tuple[str, bool, bool, float, int, int, int]] = []
    numbers = 0
    commented: tuple[int, int] | None = None  # under a heading of comments: how many holders are open around it, and its level
    open_: Counter[str | int] = Counter()  # how many holders are open, by tag, and (1, 2, 3) apart, articles and headings

    def count(holder: tuple[str, bool, bool, float, int, int, int], by: int) -> None:
        open_[holder[0]] += by
        open_[1] += by * holder[1]
        open_[2] += by * holder[2]
        open_[3] += by * (holder[0] in HEADINGS)

    parts: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        nonlocal commented
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                texts.append(text)
                links, words = len(html.unescape(" ".join(linked)).split()), len(text.split())
                level = next((int(h[0][1]) for h in reversed(stack) if h[0] in HEADINGS), 0)
                if level:
                    if _COMMENTS.fullmatch(text):
                        commented = next(i for i, h in enumerate(stack) if h[0] in HEADINGS), level
                    elif commented and level <= commented[1]:
                        commented = None
                _, _, _, named, outer, inner, listed = stack[-1] if stack else ("", False, False, 0.0, 0, 0, 0)
                if not outer and words <= 25 and _RIGHTS.match(text):
                    named = 1.0
                prose = any(h[0] in PROSE for h in stack[-3:])
                rows.append((words, links, level > 0, open_[1] > 0 or commented is not None, named, outer, inner, listed, prose))
            parts.clear()
            linked.clear()

    at, size = 0, len(page)
    while at < size:
        match = _TOKEN.search(page, at)
        end = match.start() if match else size
        if end > at:
            parts.append(page[at:end])
            if open_["a"]:
                linked.append(page[at:end])
        if not match:
            break
        at = match.end()
        closing, tag, attributes = match[1], match[2], match[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK or tag in HIDDEN:
            flush()
        if tag in HIDDEN and not closing:
            if not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\s*(?:>|\Z)", re.I).search(page, at)
                at = stop.end() if stop else size
        elif closing:
            if open_[tag]:
                last = None
                while last != tag:
                    holder = stack.pop()
                    count(holder, -1)
                    last = holder[0]
                if commented and len(stack) < commented[0]:
                    commented = None
        elif tag in HOLDS and tag not in VOID:
            if tag in ("p", "li", "a", "td", "th", "tr", "dd", "dt") and stack and stack[-1][0] == tag:
                count(stack.pop(), -1)
            apart, named = _apart(tag, attributes, open_[2] > 0), hint(tag, attributes)
            if tag == "span" and not apart and named < 1:
                continue
            if tag == "span":
                flush()
            article = tag in ("article", "main")
            _, _, _, most, outer, inner, listed = stack[-1] if stack else ("", False, False, 0.0, 0, 0, 0)
            numbers += 1
            if article:
                outer, inner = outer or numbers, numbers
            stack.append((tag, apart, article, max(named, most), outer, inner, numbers if tag in LISTS else listed))
            count(stack[-1], 1)
    flush()
    n = len(rows)
    out = np.zeros((n, len(FEATURES)))
    if n:
        raw = np.array(rows, float)
        words, links, outer, inner, listed = (raw[:, k].astype(int) for k in (0, 1, 5, 6, 7))
        sums = lambda group: [np.bincount(group, w, numbers + 1) for w in (words, links, None)]
        # articles with little text of their own don't count, nor do links to others within one
        own = lambda group: np.bincount(group, np.maximum(words - links, 0) * (raw[:, 3] == 0), numbers + 1)
        whole = own(outer)
        whole[0] = 0
        counts = (outer > 0) & (whole[outer] >= SHARE * whole.max(initial=0)) & (whole[outer] > 0)
        teaser = (inner > 0) & (inner != outer) & (own(inner)[inner] == 0)
        total, linked_words, entries = sums(listed)
        menu = (listed > 0) & ((linked_words >= LINKED * total) & (total <= SHORT * entries))[listed]
        raw[:, 3] = (raw[:, 3] > 0) | menu | teaser
        has_article = bool(counts.any())
        raw[:, 5] = counts
        out[:, 0], out[:, 1] = raw[:, 0], np.minimum(raw[:, 1] / np.maximum(raw[:, 0], 1), 1)
        for column, step in ((2, -1), (4, 1)):
            # the longer one of the two blocks on that side
            at1, at2 = np.arange(n) + step, np.arange(n) + 2 * step
            near = lambda at: np.where((at >= 0) & (at < n), raw[np.clip(at, 0, n - 1), 0], 0)
            best = np.where(near(at2) > near(at1), at2, at1)
            there = (best >= 0) & (best < n)
            out[:, column] = near(best)
            out[:, column + 1] = np.where(there, out[np.clip(best, 0, n - 1), 1], 0)
        out[:, 6:10], out[:, 10], out[:, 11] = raw[:, 2:6], has_article, raw[:, 8]
    return texts, out


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12) -> dict | float:
    """A decision tree: the split of least Gini impurity, halfway between neighbouring values; the first feature on ties."""
    if depth == 0 or len(y) < 2 or y.min() == y.max():
        return float(y.mean())
    best = None
    for feature in range(x.shape[1]):
        values = np.unique(x[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            left = x[:, feature] <= cut
            impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (y[left], y[~left]))
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, feature, float(cut)
    if best is None:
        return float(y.mean())
    _, feature, cut = best
    left = x[:, feature] <= cut
    return {"feature": feature, "cut": cut, "low": grow(x[left], y[left], depth - 1), "high": grow(x[~left], y[~left], depth - 1)}


def fit(labelled=LABELLED) -> dict | float:
    """The tree of a labelled table; on pages with an article, and for links and parts that stand apart, it doesn't matter whether a block is prose."""
    table, prose = np.array(labelled, float), FEATURES.index("prose")
    either = (table[:, FEATURES.index("page_article")] == 1) | (table[:, FEATURES.index("apart")] == 1) | (table[:, FEATURES.index("links")] >= 0.5)
    other = table[either].copy()
    other[:, prose] = 1 - other[:, prose]
    table = np.concatenate((table, other))
    return grow(table[:, :-1], table[:, -1])


def keeps(tree: dict | float, features: np.ndarray) -> np.ndarray:
    if not isinstance(tree, dict):
        return np.full(len(features), tree >= 0.5)
    low = features[:, tree["feature"]] <= tree["cut"]
    out = np.empty(len(features), bool)
    out[low], out[~low] = keeps(tree["low"], features[low]), keeps(tree["high"], features[~low])
    return out


def main_text(page: str | None, tree: dict | float) -> str:
    texts, features = blocks_of(page or "")
    return "\n".join(text for text, kept in zip(texts, keeps(tree, features)) if kept)


def extract(pages: DataFrame, labelled=LABELLED) -> DataFrame:
    """(page_id, url, text, n_chars) of every page (page_id, url, html)."""
    tree = fit(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [main_text(page.as_py(), tree) for page in part.column("html")]
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
