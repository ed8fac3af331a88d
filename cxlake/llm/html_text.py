"""Main text of web pages from flat text blocks.

A page is cut into flat blocks of text at block-level tags; no tree is built.
Each block has its word count and link density and those of its neighbours,
the share of its words in the page, and what its tags say (inside an
article-like container, inside a boilerplate container, heading). A decision
tree trained on a small labelled table of such blocks (``LABELLED``) decides
which blocks are main text.

Scripts, styles, comments, forms, the head, and elements that are not shown
give no blocks. Character references are decoded, white space inside a block
becomes one space, blocks are trimmed, and kept blocks are joined in page order
by one line feed.

Containers are followed by a stack of sectioning tags only (``div``, ``nav``,
``article`` ...): unclosed paragraphs and inline tags do no harm, an end tag
without a start is ignored, and an end tag closes what was left open inside.

Defined results: a null or empty page, and a page without main text, give an
empty text of 0 characters; markup that never ends (an unclosed script or
comment) swallows the rest of the page, as browsers do.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cxlake.llm.shared import small_batches

# Tags that end a block; tags whose content is never text of the
# page; tags kept on the container stack; containers of main text and of
# boilerplate; words in class or id that name boilerplate.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
RAW_TAGS = frozenset("script style noscript template textarea svg math iframe object title head select option button".split())
CONTAINERS = frozenset("article aside body details dialog div fieldset footer form header main menu nav ol section table ul".split())
MAIN_CONTAINERS = frozenset("article main".split())
BOILERPLATE_CONTAINERS = frozenset("aside dialog fieldset footer form menu nav".split())
BOILERPLATE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|side-?bar|menu|nav\w*|breadcrumbs?|header|footer|cookies?|consent|notice|alert|popup|modal|"
    r"newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|comments?|replies|reply|disqus|respond|widget|copyright|legal|skip|toolbar|pagination|pager|tags?|meta|byline-share)(?:$|[\s_-])",
    re.I,
)
# whole class tokens: ``text-center`` or ``main-logo`` say nothing
MAIN_NAMES = re.compile(
    r"(?:^|\s)(?:article|article-?body|article-content|main|main-content|content|post|post-body|post-content|entry|entry-content|story|story-body|text|body)(?:$|\s)", re.I
)
HIDDEN = re.compile(r"""\shidden(?=[\s>=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
NAMED = re.compile(r"""\s(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
SPACE = re.compile(r"\s+")

FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "main", "boilerplate", "heading", "main_page")
# A small labelled table of blocks: the features above, then 1 for main text.
# ``main`` and ``boilerplate``: inside such a container; ``main_page``: the page
# has an article-like container. Containers do not settle the class: outside of
# them long blocks of few links, and shorter ones and headings next to such blocks, are main
# text; inside, blocks of links beside anything but prose are not.
LABELLED = (
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 1, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 1, 0), (2, 1.0, 1, 1.0, 9, 0.0, 0, 1, 0, 1, 0),
    (9, 0.0, 2, 1.0, 11, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 1, 1.0, 4, 0.0, 0, 1, 0, 1, 0), (14, 0.0, 1, 1.0, 10, 0.0, 0, 1, 0, 1, 0),
    (6, 0.0, 48, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (12, 0.0, 3, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (25, 0.1, 80, 0.0, 30, 0.0, 0, 1, 0, 1, 0),
    (40, 0.0, 60, 0.0, 35, 0.0, 1, 1, 0, 1, 0), (3, 0.0, 60, 0.0, 22, 0.0, 1, 1, 0, 1, 0), (18, 0.2, 2, 0.0, 50, 0.0, 1, 1, 0, 1, 0),
    (30, 0.0, 3, 0.0, 28, 0.0, 0, 1, 0, 1, 0), (5, 0.8, 40, 0.0, 6, 0.9, 1, 1, 0, 1, 0), (2, 0.0, 5, 0.0, 30, 0.0, 0, 1, 1, 1, 0),
    (10, 0.0, 12, 0.0, 80, 0.0, 1, 0, 1, 1, 1), (3, 0.0, 9, 0.0, 70, 0.0, 1, 0, 1, 1, 1), (1, 0.0, 40, 0.0, 90, 0.0, 1, 0, 0, 1, 1),
    (1, 0.0, 9, 0.0, 1, 0.0, 1, 0, 0, 1, 1), (2, 0.0, 1, 0.0, 6, 0.0, 1, 0, 0, 1, 1), (60, 0.0, 3, 0.0, 45, 0.0, 1, 0, 0, 1, 1),
    (120, 0.05, 60, 0.0, 80, 0.0, 1, 0, 0, 1, 1), (250, 0.0, 90, 0.0, 7, 0.0, 1, 0, 0, 1, 1), (14, 0.0, 70, 0.0, 6, 0.0, 1, 0, 0, 1, 1),
    (8, 0.3, 30, 0.0, 30, 0.0, 1, 0, 0, 1, 1), (4, 1.0, 30, 0.0, 40, 0.0, 1, 0, 0, 1, 1), (5, 0.5, 12, 0.0, 15, 0.1, 1, 0, 0, 1, 0),
    (20, 0.2, 20, 0.2, 20, 0.2, 1, 0, 0, 1, 1), (35, 0.0, 10, 0.0, 12, 0.0, 1, 0, 0, 1, 1), (1, 1.0, 35, 0.0, 25, 0.0, 1, 0, 0, 1, 1),
    (40, 0.0, 1, 1.0, 1, 1.0, 1, 0, 0, 1, 1), (2, 0.0, 1, 1.0, 1, 1.0, 1, 0, 0, 1, 1), (6, 0.0, 2, 1.0, 0, 0.0, 1, 0, 0, 1, 1),
    (70, 0.0, 3, 1.0, 0, 0.0, 1, 0, 0, 1, 1), (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1, 1), (12, 0.0, 0, 0.0, 4, 1.0, 1, 0, 1, 1, 1),
    (3, 0.0, 0, 0.0, 5, 0.9, 1, 0, 0, 1, 1), (9, 1.0, 6, 1.0, 7, 1.0, 1, 0, 0, 1, 0), (2, 1.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1, 0),
    (25, 0.6, 9, 0.8, 12, 0.7, 1, 0, 0, 1, 0), (90, 0.0, 8, 0.9, 9, 0.9, 1, 0, 0, 1, 1), (1, 0.0, 5, 0.5, 2, 1.0, 1, 0, 1, 1, 1),
    (80, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 1, 1), (20, 0.0, 45, 0.0, 6, 0.0, 0, 0, 0, 1, 0), (2, 0.0, 9, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (8, 0.0, 20, 0.0, 33, 0.0, 0, 0, 1, 1, 1), (55, 0.1, 0, 0.0, 70, 0.0, 0, 0, 0, 1, 1), (4, 0.0, 60, 0.0, 15, 0.0, 0, 0, 0, 1, 0),
    (4, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 1, 0), (10, 0.0, 3, 1.0, 20, 0.0, 0, 0, 0, 1, 0), (30, 0.0, 2, 1.0, 40, 0.0, 0, 0, 0, 1, 0),
    (6, 0.0, 70, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (3, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 1, 0), (5, 0.0, 1, 1.0, 60, 0.0, 0, 0, 1, 1, 1),
    (18, 0.5, 60, 0.0, 2, 1.0, 0, 0, 0, 1, 0), (45, 0.0, 6, 0.0, 8, 0.3, 0, 0, 0, 1, 1), (2, 1.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 0),
    (3, 1.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0, 0), (1, 1.0, 4, 1.0, 25, 0.0, 0, 0, 0, 0, 0), (5, 0.9, 30, 0.0, 4, 1.0, 0, 0, 0, 0, 0),
    (12, 0.7, 8, 0.8, 9, 0.8, 0, 0, 0, 0, 0), (20, 0.6, 5, 1.0, 6, 1.0, 0, 0, 0, 0, 0), (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 0),
    (3, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 0, 0), (5, 0.2, 6, 0.5, 5, 0.6, 0, 0, 0, 0, 0), (6, 0.0, 3, 0.0, 45, 0.0, 0, 0, 1, 0, 1),
    (9, 0.0, 1, 1.0, 70, 0.0, 0, 0, 1, 0, 1), (30, 0.0, 8, 0.0, 40, 0.0, 0, 0, 0, 0, 1), (70, 0.05, 2, 1.0, 30, 0.0, 0, 0, 0, 0, 1),
    (25, 0.1, 60, 0.0, 3, 1.0, 0, 0, 0, 0, 1), (15, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 0, 1), (3, 0.0, 30, 0.0, 30, 0.0, 0, 0, 0, 0, 1),
    (8, 0.1, 25, 0.0, 22, 0.0, 0, 0, 0, 0, 1), (150, 0.0, 20, 0.0, 60, 0.0, 0, 0, 0, 0, 1), (80, 0.0, 60, 0.0, 4, 1.0, 0, 0, 0, 0, 1),
    (60, 0.0, 20, 0.0, 10, 0.5, 0, 0, 0, 0, 1), (45, 0.0, 50, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (90, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1),
    (33, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0, 0, 1), (70, 0.0, 60, 0.0, 50, 0.0, 0, 1, 0, 0, 0), (60, 0.0, 20, 0.0, 10, 0.5, 0, 1, 0, 0, 0),
    (9, 0.0, 2, 1.0, 30, 0.0, 0, 1, 0, 0, 0), (12, 0.0, 70, 0.0, 0, 0.0, 0, 1, 0, 0, 0), (7, 0.12, 29, 0.05, 4, 0.7, 0, 0, 0, 1, 0),
    (13, 0.0, 120, 0.1, 1, 0.9, 0, 0, 0, 1, 0), (1, 0.02, 36, 0.02, 35, 0.55, 0, 0, 0, 1, 0), (18, 0.0, 36, 0.1, 71, 0.9, 0, 0, 0, 1, 0),
    (2, 0.1, 201, 0.05, 0, 0.0, 0, 0, 0, 1, 0), (2, 0.02, 7, 0.1, 29, 0.0, 0, 0, 0, 1, 0), (10, 0.0, 8, 0.05, 46, 0.05, 0, 0, 0, 1, 0),
    (70, 0.0, 9, 0.0, 28, 0.02, 0, 0, 0, 1, 1), (2, 0.0, 8, 0.02, 1, 0.0, 0, 0, 0, 1, 0), (29, 0.12, 2, 0.0, 5, 0.1, 0, 0, 0, 1, 0),
    (1, 0.0, 1, 0.1, 13, 0.9, 0, 0, 0, 1, 0), (9, 0.0, 8, 0.02, 7, 0.9, 0, 0, 0, 1, 0), (5, 0.05, 12, 0.1, 28, 0.9, 0, 0, 0, 1, 0),
    (7, 0.05, 2, 0.05, 0, 0.0, 0, 0, 0, 1, 0), (13, 0.05, 7, 0.12, 0, 0.0, 0, 0, 0, 1, 0), (45, 0.0, 9, 0.0, 0, 0.0, 0, 0, 0, 1, 1),
    (7, 0.05, 1, 1.0, 45, 0.02, 0, 0, 0, 1, 0), (9, 0.05, 9, 0.9, 121, 0.05, 0, 0, 0, 1, 0), (29, 0.12, 1, 1.0, 35, 0.12, 0, 0, 0, 1, 0),
    (10, 0.05, 2, 0.7, 7, 0.1, 0, 0, 0, 1, 0), (45, 0.02, 2, 0.7, 2, 0.05, 0, 0, 0, 1, 1), (5, 0.12, 12, 0.55, 18, 1.0, 0, 0, 0, 1, 0),
    (70, 0.02, 2, 1.0, 3, 0.55, 0, 0, 0, 1, 1), (24, 0.0, 3, 0.7, 45, 1.0, 0, 0, 0, 1, 0), (70, 0.0, 2, 0.9, 29, 1.0, 0, 0, 0, 1, 1),
    (4, 0.05, 5, 0.55, 0, 0.0, 0, 0, 0, 1, 0), (7, 0.05, 71, 0.9, 45, 0.02, 0, 0, 0, 1, 0), (3, 0.0, 46, 0.55, 7, 0.0, 0, 0, 0, 1, 0),
    (18, 0.02, 28, 0.9, 4, 0.05, 0, 0, 0, 1, 0), (71, 0.0, 71, 0.55, 2, 0.0, 0, 0, 0, 1, 1), (120, 0.0, 36, 0.55, 5, 0.55, 0, 0, 0, 1, 1),
    (120, 0.05, 29, 0.9, 35, 1.0, 0, 0, 0, 1, 1), (45, 0.0, 29, 0.7, 0, 0.0, 0, 0, 0, 1, 1), (7, 0.0, 0, 0.0, 19, 0.12, 0, 0, 0, 1, 0),
    (36, 0.05, 0, 0.0, 2, 0.1, 0, 0, 0, 1, 0), (29, 0.02, 0, 0.0, 7, 1.0, 0, 0, 0, 1, 0), (19, 0.1, 0, 0.0, 29, 0.9, 0, 0, 0, 1, 0),
    (25, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (28, 0.02, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (12, 0.18, 46, 0.0, 35, 0.1, 0, 0, 0, 1, 0),
    (36, 0.18, 121, 0.1, 200, 0.1, 0, 0, 0, 1, 1), (3, 0.4, 29, 0.05, 4, 0.05, 0, 0, 0, 1, 0), (71, 0.18, 29, 0.12, 2, 0.0, 0, 0, 0, 1, 1),
    (19, 0.25, 70, 0.02, 5, 1.0, 0, 0, 0, 1, 0), (7, 0.18, 46, 0.0, 28, 1.0, 0, 0, 0, 1, 0), (25, 0.25, 71, 0.0, 70, 0.55, 0, 0, 0, 1, 1),
    (8, 0.3, 29, 0.12, 0, 0.0, 0, 0, 0, 1, 0), (18, 0.25, 46, 0.02, 0, 0.0, 0, 0, 0, 1, 0), (24, 0.45, 4, 0.1, 45, 0.02, 0, 0, 0, 1, 0),
    (46, 0.45, 7, 0.12, 28, 0.12, 0, 0, 0, 1, 1), (3, 0.3, 3, 0.1, 7, 0.55, 0, 0, 0, 1, 0), (19, 0.45, 2, 0.1, 13, 0.55, 0, 0, 0, 1, 0),
    (1, 0.4, 1, 0.12, 35, 0.7, 0, 0, 0, 1, 0), (10, 0.25, 7, 0.02, 45, 0.55, 0, 0, 0, 1, 0), (46, 0.3, 12, 0.02, 45, 0.9, 0, 0, 0, 1, 0),
    (70, 0.3, 3, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (13, 0.18, 2, 0.7, 36, 0.1, 0, 0, 0, 1, 0), (4, 0.45, 12, 0.55, 8, 0.02, 0, 0, 0, 1, 0),
    (10, 0.3, 5, 0.7, 10, 0.0, 0, 0, 0, 1, 0), (70, 0.25, 19, 0.7, 7, 0.0, 0, 0, 0, 1, 0), (2, 0.18, 3, 0.9, 3, 0.7, 0, 0, 0, 1, 0),
    (13, 0.4, 8, 0.55, 2, 0.7, 0, 0, 0, 1, 0), (10, 0.25, 8, 0.7, 45, 1.0, 0, 0, 0, 1, 0), (120, 0.18, 8, 0.55, 46, 1.0, 0, 0, 0, 1, 0),
    (45, 0.3, 19, 1.0, 0, 0.0, 0, 0, 0, 1, 0), (3, 0.25, 29, 0.7, 29, 0.0, 0, 0, 0, 1, 0), (10, 0.25, 29, 0.7, 71, 0.05, 0, 0, 0, 1, 0),
    (121, 0.3, 70, 0.9, 121, 0.02, 0, 0, 0, 1, 1), (10, 0.3, 29, 0.55, 13, 0.05, 0, 0, 0, 1, 0), (35, 0.25, 35, 0.7, 2, 0.0, 0, 0, 0, 1, 0),
    (18, 0.4, 71, 0.7, 1, 0.9, 0, 0, 0, 1, 0), (2, 0.45, 35, 1.0, 28, 0.9, 0, 0, 0, 1, 0), (9, 0.18, 70, 0.55, 36, 0.9, 0, 0, 0, 1, 0),
    (120, 0.18, 29, 1.0, 45, 0.7, 0, 0, 0, 1, 0), (19, 0.3, 35, 0.7, 0, 0.0, 0, 0, 0, 1, 0), (24, 0.4, 0, 0.0, 120, 0.0, 0, 0, 0, 1, 0),
    (29, 0.25, 0, 0.0, 71, 0.05, 0, 0, 0, 1, 1), (4, 0.3, 0, 0.0, 18, 0.02, 0, 0, 0, 1, 0), (9, 0.3, 0, 0.0, 18, 0.0, 0, 0, 0, 1, 0),
    (8, 0.25, 0, 0.0, 70, 0.7, 0, 0, 0, 1, 0), (10, 0.18, 0, 0.0, 45, 1.0, 0, 0, 0, 1, 0), (70, 0.3, 0, 0.0, 36, 1.0, 0, 0, 0, 1, 0),
    (4, 0.45, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (18, 0.45, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (29, 0.18, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (24, 0.9, 201, 0.0, 200, 0.1, 0, 0, 0, 1, 0), (3, 0.55, 35, 0.1, 1, 0.12, 0, 0, 0, 1, 0), (29, 1.0, 28, 0.12, 9, 0.02, 0, 0, 0, 1, 0),
    (2, 0.55, 36, 0.05, 2, 0.7, 0, 0, 0, 1, 0), (18, 1.0, 29, 0.1, 2, 0.9, 0, 0, 0, 1, 0), (120, 0.7, 201, 0.0, 1, 0.7, 0, 0, 0, 1, 0),
    (4, 0.55, 29, 0.0, 35, 0.55, 0, 0, 0, 1, 0), (9, 1.0, 70, 0.0, 71, 0.9, 0, 0, 0, 1, 0), (70, 0.9, 201, 0.0, 29, 0.55, 0, 0, 0, 1, 0),
    (3, 0.55, 35, 0.02, 0, 0.0, 0, 0, 0, 1, 0), (19, 0.7, 46, 0.12, 0, 0.0, 0, 0, 0, 1, 0), (45, 0.9, 201, 0.02, 0, 0.0, 0, 0, 0, 1, 0),
    (1, 0.7, 3, 0.02, 1, 0.9, 0, 0, 0, 1, 0), (2, 0.55, 9, 0.0, 45, 0.9, 0, 0, 0, 1, 0), (25, 0.9, 1, 0.02, 36, 1.0, 0, 0, 0, 1, 0),
    (5, 1.0, 10, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (5, 1.0, 5, 0.9, 70, 0.0, 0, 0, 0, 1, 0), (25, 0.7, 2, 0.7, 201, 0.02, 0, 0, 0, 1, 0),
    (19, 0.55, 12, 0.55, 4, 0.0, 0, 0, 0, 1, 0), (29, 0.9, 2, 0.55, 9, 0.0, 0, 0, 0, 1, 0), (4, 0.7, 12, 0.55, 9, 1.0, 0, 0, 0, 1, 0),
    (9, 0.9, 13, 0.7, 7, 0.7, 0, 0, 0, 1, 0), (3, 0.9, 2, 1.0, 29, 0.9, 0, 0, 0, 1, 0), (13, 0.7, 7, 1.0, 0, 0.0, 0, 0, 0, 1, 0),
    (35, 0.9, 5, 0.7, 0, 0.0, 0, 0, 0, 1, 0), (10, 1.0, 35, 0.7, 121, 0.0, 0, 0, 0, 1, 0), (4, 0.55, 35, 0.7, 4, 1.0, 0, 0, 0, 1, 0),
    (71, 0.9, 46, 1.0, 5, 0.9, 0, 0, 0, 1, 0), (24, 0.7, 28, 0.55, 45, 0.7, 0, 0, 0, 1, 0), (7, 1.0, 45, 0.7, 0, 0.0, 0, 0, 0, 1, 0),
    (9, 0.55, 46, 0.7, 0, 0.0, 0, 0, 0, 1, 0), (36, 1.0, 70, 0.9, 0, 0.0, 0, 0, 0, 1, 0), (2, 0.9, 0, 0.0, 70, 0.12, 0, 0, 0, 1, 0),
    (19, 0.9, 0, 0.0, 71, 0.02, 0, 0, 0, 1, 0), (120, 0.7, 0, 0.0, 36, 0.1, 0, 0, 0, 1, 0), (2, 1.0, 0, 0.0, 3, 0.02, 0, 0, 0, 1, 0),
    (120, 0.7, 0, 0.0, 18, 0.0, 0, 0, 0, 1, 0), (4, 0.55, 0, 0.0, 10, 0.55, 0, 0, 0, 1, 0), (13, 0.9, 0, 0.0, 9, 0.55, 0, 0, 0, 1, 0),
    (28, 0.55, 0, 0.0, 13, 0.9, 0, 0, 0, 1, 0), (10, 0.55, 0, 0.0, 28, 1.0, 0, 0, 0, 1, 0), (36, 0.55, 0, 0.0, 45, 0.55, 0, 0, 0, 1, 0),
    (8, 0.55, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (25, 0.7, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (46, 1.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (2, 0.0, 4, 0.7, 36, 0.02, 0, 0, 1, 1, 1), (8, 0.1, 0, 0.0, 35, 0.0, 0, 0, 1, 1, 1), (5, 0.0, 35, 0.55, 5, 0.05, 0, 0, 1, 1, 0),
    (4, 0.05, 4, 1.0, 10, 0.02, 0, 0, 1, 1, 0), (3, 0.02, 28, 0.7, 10, 0.55, 0, 0, 1, 1, 0), (8, 0.1, 0, 0.0, 5, 1.0, 0, 0, 1, 1, 0),
    (1, 0.12, 19, 0.0, 70, 0.9, 0, 0, 1, 1, 0), (9, 0.05, 46, 1.0, 45, 0.9, 0, 0, 1, 1, 0), (10, 0.1, 1, 0.9, 0, 0.0, 0, 0, 1, 1, 0),
    (12, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 1, 0), (25, 0.1, 71, 0.7, 29, 0.0, 0, 0, 0, 1, 0), (35, 0.7, 28, 0.7, 35, 0.0, 0, 0, 0, 1, 0),
    (19, 0.12, 28, 0.12, 45, 0.55, 0, 0, 0, 1, 0), (36, 1.0, 121, 0.1, 46, 0.9, 0, 0, 0, 1, 0), (10, 0.0, 46, 0.55, 36, 0.7, 0, 0, 0, 1, 0),
    (46, 0.55, 28, 0.55, 70, 0.7, 0, 0, 0, 1, 0), (46, 0.12, 28, 0.12, 120, 0.02, 0, 0, 0, 0, 1), (2, 0.1, 28, 0.0, 13, 0.1, 0, 0, 0, 0, 0),
    (9, 0.12, 35, 0.12, 2, 0.02, 0, 0, 0, 0, 1), (201, 0.0, 70, 0.02, 19, 0.12, 0, 0, 0, 0, 1), (10, 0.05, 36, 0.1, 13, 1.0, 0, 0, 0, 0, 1),
    (29, 0.12, 28, 0.05, 9, 0.7, 0, 0, 0, 0, 1), (2, 0.12, 45, 0.0, 45, 0.55, 0, 0, 0, 0, 0), (18, 0.02, 35, 0.0, 35, 1.0, 0, 0, 0, 0, 1),
    (35, 0.02, 70, 0.05, 45, 1.0, 0, 0, 0, 0, 1), (2, 0.12, 29, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (46, 0.0, 36, 0.0, 0, 0.0, 0, 0, 0, 0, 1),
    (10, 0.0, 19, 0.12, 201, 0.02, 0, 0, 0, 0, 1), (46, 0.12, 9, 0.1, 201, 0.0, 0, 0, 0, 0, 1), (3, 0.05, 8, 0.05, 12, 0.05, 0, 0, 0, 0, 0),
    (2, 0.1, 4, 0.12, 8, 1.0, 0, 0, 0, 0, 0), (25, 0.02, 7, 0.1, 7, 1.0, 0, 0, 0, 0, 1), (35, 0.1, 8, 0.05, 4, 0.7, 0, 0, 0, 0, 1),
    (25, 0.0, 2, 0.1, 70, 0.7, 0, 0, 0, 0, 1), (120, 0.0, 10, 0.0, 46, 0.9, 0, 0, 0, 0, 1), (13, 0.05, 5, 0.1, 0, 0.0, 0, 0, 0, 0, 0),
    (29, 0.0, 1, 0.05, 0, 0.0, 0, 0, 0, 0, 1), (12, 0.02, 3, 0.55, 45, 0.1, 0, 0, 0, 0, 1), (13, 0.0, 8, 0.55, 12, 0.1, 0, 0, 0, 0, 0),
    (24, 0.05, 7, 0.9, 2, 0.55, 0, 0, 0, 0, 0), (24, 0.05, 8, 0.9, 70, 0.55, 0, 0, 0, 0, 0), (12, 0.1, 2, 0.7, 0, 0.0, 0, 0, 0, 0, 0),
    (29, 0.0, 19, 1.0, 0, 0.0, 0, 0, 0, 0, 1), (4, 0.02, 36, 0.7, 200, 0.1, 0, 0, 0, 0, 0), (24, 0.1, 28, 1.0, 71, 0.12, 0, 0, 0, 0, 1),
    (5, 0.12, 36, 0.9, 5, 0.05, 0, 0, 0, 0, 0), (18, 0.02, 71, 0.7, 8, 0.0, 0, 0, 0, 0, 0), (35, 0.0, 35, 0.9, 10, 0.0, 0, 0, 0, 0, 1),
    (3, 0.1, 70, 0.55, 19, 0.9, 0, 0, 0, 0, 0), (7, 0.1, 28, 0.9, 36, 1.0, 0, 0, 0, 0, 0), (25, 0.1, 29, 0.55, 0, 0.0, 0, 0, 0, 0, 1),
    (28, 0.1, 70, 0.7, 0, 0.0, 0, 0, 0, 0, 1), (7, 0.02, 0, 0.0, 71, 0.1, 0, 0, 0, 0, 0), (70, 0.05, 0, 0.0, 120, 0.05, 0, 0, 0, 0, 1),
    (24, 0.02, 0, 0.0, 18, 0.1, 0, 0, 0, 0, 0), (121, 0.05, 0, 0.0, 2, 0.1, 0, 0, 0, 0, 1), (2, 0.1, 0, 0.0, 19, 0.9, 0, 0, 0, 0, 0),
    (70, 0.0, 0, 0.0, 28, 0.7, 0, 0, 0, 0, 1), (12, 0.1, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (4, 0.25, 35, 0.1, 29, 0.1, 0, 0, 0, 0, 0),
    (36, 0.4, 36, 0.05, 36, 0.0, 0, 0, 0, 0, 1), (35, 0.25, 71, 0.05, 1, 0.12, 0, 0, 0, 0, 1), (4, 0.18, 36, 0.02, 3, 0.9, 0, 0, 0, 0, 0),
    (70, 0.4, 29, 0.1, 5, 0.55, 0, 0, 0, 0, 1), (7, 0.18, 201, 0.0, 46, 0.7, 0, 0, 0, 0, 0), (19, 0.18, 121, 0.12, 29, 0.9, 0, 0, 0, 0, 0),
    (36, 0.25, 46, 0.12, 36, 1.0, 0, 0, 0, 0, 1), (25, 0.18, 36, 0.1, 0, 0.0, 0, 0, 0, 0, 1), (121, 0.4, 28, 0.0, 0, 0.0, 0, 0, 0, 0, 1),
    (1, 0.3, 3, 0.05, 70, 0.0, 0, 0, 0, 0, 0), (46, 0.3, 2, 0.0, 35, 0.0, 0, 0, 0, 0, 1), (2, 0.18, 8, 0.0, 13, 0.12, 0, 0, 0, 0, 0),
    (45, 0.18, 4, 0.0, 2, 0.0, 0, 0, 0, 0, 0), (18, 0.25, 12, 0.1, 5, 0.9, 0, 0, 0, 0, 0), (71, 0.4, 1, 0.0, 5, 0.55, 0, 0, 0, 0, 0),
    (4, 0.25, 7, 0.05, 70, 0.55, 0, 0, 0, 0, 0), (10, 0.3, 2, 0.1, 46, 0.7, 0, 0, 0, 0, 0), (36, 0.45, 5, 0.12, 28, 0.55, 0, 0, 0, 0, 0),
    (5, 0.25, 1, 0.05, 0, 0.0, 0, 0, 0, 0, 0), (9, 0.25, 12, 0.05, 0, 0.0, 0, 0, 0, 0, 0), (121, 0.25, 8, 0.02, 0, 0.0, 0, 0, 0, 0, 0),
    (4, 0.3, 4, 0.7, 120, 0.05, 0, 0, 0, 0, 0), (13, 0.3, 10, 0.7, 121, 0.05, 0, 0, 0, 0, 0), (200, 0.45, 1, 0.9, 70, 0.12, 0, 0, 0, 0, 1),
    (2, 0.25, 18, 0.7, 2, 0.02, 0, 0, 0, 0, 0), (25, 0.45, 4, 0.9, 3, 0.9, 0, 0, 0, 0, 0), (121, 0.45, 7, 1.0, 1, 1.0, 0, 0, 0, 0, 0),
    (4, 0.4, 4, 0.9, 35, 0.55, 0, 0, 0, 0, 0), (18, 0.25, 9, 0.7, 36, 0.9, 0, 0, 0, 0, 0), (2, 0.45, 7, 0.9, 0, 0.0, 0, 0, 0, 0, 0),
    (70, 0.45, 13, 1.0, 0, 0.0, 0, 0, 0, 0, 0), (36, 0.3, 70, 0.9, 200, 0.02, 0, 0, 0, 0, 1), (29, 0.4, 35, 1.0, 4, 0.12, 0, 0, 0, 0, 0),
    (29, 0.25, 71, 1.0, 2, 0.55, 0, 0, 0, 0, 0), (24, 0.45, 29, 0.7, 29, 0.7, 0, 0, 0, 0, 0), (121, 0.4, 46, 0.7, 46, 0.7, 0, 0, 0, 0, 0),
    (5, 0.45, 35, 0.9, 0, 0.0, 0, 0, 0, 0, 0), (46, 0.4, 36, 0.9, 0, 0.0, 0, 0, 0, 0, 0), (2, 0.25, 0, 0.0, 46, 0.05, 0, 0, 0, 0, 0),
    (35, 0.4, 0, 0.0, 120, 0.1, 0, 0, 0, 0, 1), (2, 0.3, 0, 0.0, 1, 0.1, 0, 0, 0, 0, 0), (18, 0.25, 0, 0.0, 19, 0.05, 0, 0, 0, 0, 0),
    (70, 0.25, 0, 0.0, 5, 0.1, 0, 0, 0, 0, 0), (121, 0.18, 0, 0.0, 12, 0.7, 0, 0, 0, 0, 0), (8, 0.4, 0, 0.0, 29, 0.9, 0, 0, 0, 0, 0),
    (13, 0.18, 0, 0.0, 29, 0.55, 0, 0, 0, 0, 0), (7, 0.3, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (8, 1.0, 28, 0.1, 28, 0.0, 0, 0, 0, 0, 0),
    (46, 0.55, 46, 0.12, 120, 0.02, 0, 0, 0, 0, 0), (13, 0.9, 36, 0.1, 19, 0.7, 0, 0, 0, 0, 0), (71, 0.7, 28, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (25, 1.0, 9, 0.0, 35, 0.02, 0, 0, 0, 0, 0), (71, 1.0, 2, 0.12, 46, 0.0, 0, 0, 0, 0, 0), (2, 0.7, 2, 0.0, 8, 0.02, 0, 0, 0, 0, 0),
    (36, 0.9, 5, 0.0, 5, 0.02, 0, 0, 0, 0, 0), (2, 0.55, 2, 0.0, 12, 1.0, 0, 0, 0, 0, 0), (3, 0.55, 13, 0.0, 35, 0.55, 0, 0, 0, 0, 0),
    (200, 0.55, 2, 0.1, 36, 1.0, 0, 0, 0, 0, 0), (2, 0.7, 9, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (25, 1.0, 18, 0.12, 0, 0.0, 0, 0, 0, 0, 0),
    (201, 0.7, 12, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (3, 0.9, 2, 0.7, 201, 0.05, 0, 0, 0, 0, 0), (46, 0.9, 2, 0.55, 201, 0.0, 0, 0, 0, 0, 0),
    (36, 0.55, 13, 0.55, 1, 0.12, 0, 0, 0, 0, 0), (4, 1.0, 1, 0.9, 10, 0.7, 0, 0, 0, 0, 0), (5, 0.9, 19, 0.7, 71, 0.55, 0, 0, 0, 0, 0),
    (201, 0.55, 19, 0.55, 71, 0.55, 0, 0, 0, 0, 0), (36, 1.0, 12, 1.0, 0, 0.0, 0, 0, 0, 0, 0), (5, 0.9, 70, 0.55, 36, 0.02, 0, 0, 0, 0, 0),
    (24, 0.9, 46, 0.7, 29, 0.1, 0, 0, 0, 0, 0), (121, 0.7, 36, 1.0, 29, 0.02, 0, 0, 0, 0, 0), (10, 0.55, 45, 0.9, 2, 0.0, 0, 0, 0, 0, 0),
    (8, 0.55, 35, 1.0, 19, 0.55, 0, 0, 0, 0, 0), (24, 0.9, 45, 0.7, 18, 0.7, 0, 0, 0, 0, 0), (201, 0.7, 46, 1.0, 3, 0.7, 0, 0, 0, 0, 0),
    (3, 0.7, 28, 0.7, 70, 0.7, 0, 0, 0, 0, 0), (200, 0.9, 29, 0.55, 29, 0.55, 0, 0, 0, 0, 0), (3, 0.9, 71, 0.7, 0, 0.0, 0, 0, 0, 0, 0),
    (71, 0.55, 28, 0.7, 0, 0.0, 0, 0, 0, 0, 0), (70, 0.9, 0, 0.0, 29, 0.0, 0, 0, 0, 0, 0), (13, 0.7, 0, 0.0, 12, 0.1, 0, 0, 0, 0, 0),
    (2, 1.0, 0, 0.0, 18, 1.0, 0, 0, 0, 0, 0), (9, 0.9, 0, 0.0, 2, 0.55, 0, 0, 0, 0, 0), (28, 1.0, 0, 0.0, 9, 0.9, 0, 0, 0, 0, 0),
    (8, 0.55, 0, 0.0, 28, 1.0, 0, 0, 0, 0, 0), (12, 1.0, 0, 0.0, 46, 1.0, 0, 0, 0, 0, 0), (24, 1.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (71, 0.55, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (3, 0.12, 9, 0.1, 46, 0.12, 0, 0, 1, 0, 1), (9, 0.0, 19, 0.9, 70, 0.05, 0, 0, 1, 0, 1),
    (9, 0.0, 36, 1.0, 1, 0.12, 0, 0, 1, 0, 0), (10, 0.05, 36, 0.1, 19, 0.0, 0, 0, 1, 0, 0), (3, 0.1, 1, 0.7, 18, 0.9, 0, 0, 1, 0, 0),
    (4, 0.12, 36, 1.0, 3, 0.55, 0, 0, 1, 0, 0), (1, 0.0, 2, 0.12, 29, 0.55, 0, 0, 1, 0, 0), (9, 0.05, 70, 0.55, 28, 1.0, 0, 0, 1, 0, 0),
    (2, 0.0, 19, 0.12, 0, 0.0, 0, 0, 1, 0, 0), (9, 0.0, 70, 1.0, 0, 0.0, 0, 0, 1, 0, 0), (12, 0.02, 29, 0.9, 35, 0.1, 0, 0, 0, 0, 1),
    (28, 1.0, 35, 0.55, 70, 0.05, 0, 0, 0, 0, 0), (25, 0.02, 70, 0.02, 71, 0.9, 0, 0, 0, 0, 1), (29, 1.0, 29, 0.0, 29, 0.55, 0, 0, 0, 0, 0),
    (13, 0.12, 29, 0.55, 29, 0.55, 0, 0, 0, 0, 0), (36, 0.9, 36, 1.0, 29, 1.0, 0, 0, 0, 0, 0), (1, 0.05, 28, 0.0, 2, 0.12, 1, 0, 0, 1, 1),
    (71, 0.12, 200, 0.1, 7, 0.7, 1, 0, 0, 1, 1), (3, 0.05, 201, 0.05, 36, 0.55, 1, 0, 0, 1, 1), (24, 0.02, 12, 0.0, 46, 0.12, 1, 0, 0, 1, 1),
    (2, 0.0, 2, 0.0, 9, 0.1, 1, 0, 0, 1, 1), (9, 0.0, 13, 0.05, 0, 0.0, 1, 0, 0, 1, 1), (7, 0.0, 8, 0.55, 13, 0.02, 1, 0, 0, 1, 1),
    (9, 0.1, 18, 1.0, 3, 0.02, 1, 0, 0, 1, 1), (8, 0.05, 29, 1.0, 35, 0.02, 1, 0, 0, 1, 1), (19, 0.12, 36, 0.55, 28, 0.55, 1, 0, 0, 1, 1),
    (200, 0.02, 28, 0.7, 70, 0.9, 1, 0, 0, 1, 1), (25, 0.0, 0, 0.0, 46, 0.02, 1, 0, 0, 1, 1), (71, 0.05, 0, 0.0, 5, 0.55, 1, 0, 0, 1, 1),
    (8, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1, 1), (9, 0.1, 0, 0.0, 0, 0.0, 1, 0, 0, 1, 1), (1, 0.45, 29, 0.05, 28, 0.1, 1, 0, 0, 1, 1),
    (29, 0.25, 36, 0.1, 200, 0.05, 1, 0, 0, 1, 1), (7, 0.25, 45, 0.02, 4, 0.02, 1, 0, 0, 1, 1), (24, 0.4, 35, 0.02, 3, 0.12, 1, 0, 0, 1, 1),
    (5, 0.18, 28, 0.02, 13, 0.7, 1, 0, 0, 1, 1), (13, 0.18, 29, 0.02, 8, 1.0, 1, 0, 0, 1, 1), (4, 0.18, 36, 0.0, 0, 0.0, 1, 0, 0, 1, 1),
    (13, 0.3, 121, 0.12, 0, 0.0, 1, 0, 0, 1, 1), (4, 0.25, 3, 0.0, 121, 0.0, 1, 0, 0, 1, 1), (121, 0.18, 2, 0.02, 71, 0.1, 1, 0, 0, 1, 1),
    (120, 0.45, 19, 0.1, 9, 0.05, 1, 0, 0, 1, 1), (4, 0.25, 4, 0.05, 9, 0.55, 1, 0, 0, 1, 1), (4, 0.18, 8, 0.05, 70, 1.0, 1, 0, 0, 1, 1),
    (13, 0.3, 8, 0.0, 45, 0.7, 1, 0, 0, 1, 1), (2, 0.45, 8, 0.0, 0, 0.0, 1, 0, 0, 1, 1), (18, 0.3, 8, 0.0, 0, 0.0, 1, 0, 0, 1, 1),
    (4, 0.45, 10, 1.0, 70, 0.1, 1, 0, 0, 1, 1), (35, 0.18, 18, 0.9, 46, 0.0, 1, 0, 0, 1, 1), (5, 0.4, 2, 1.0, 4, 0.0, 1, 0, 0, 1, 1),
    (13, 0.45, 7, 1.0, 5, 0.0, 1, 0, 0, 1, 1), (29, 0.18, 2, 0.9, 8, 0.05, 1, 0, 0, 1, 1), (46, 0.3, 10, 1.0, 7, 1.0, 1, 0, 0, 1, 1),
    (4, 0.18, 2, 0.55, 28, 1.0, 1, 0, 0, 1, 1), (200, 0.25, 8, 1.0, 29, 0.9, 1, 0, 0, 1, 1), (18, 0.45, 1, 1.0, 0, 0.0, 1, 0, 0, 1, 1),
    (28, 0.45, 2, 0.9, 0, 0.0, 1, 0, 0, 1, 1), (2, 0.18, 46, 1.0, 36, 0.1, 1, 0, 0, 1, 1), (13, 0.45, 35, 1.0, 121, 0.0, 1, 0, 0, 1, 1),
    (71, 0.4, 35, 0.9, 120, 0.02, 1, 0, 0, 1, 1), (5, 0.3, 71, 0.7, 9, 0.0, 1, 0, 0, 1, 1), (121, 0.3, 71, 0.55, 5, 0.02, 1, 0, 0, 1, 1),
    (2, 0.45, 36, 1.0, 10, 1.0, 1, 0, 0, 1, 1), (24, 0.18, 45, 0.9, 8, 1.0, 1, 0, 0, 1, 1), (4, 0.18, 36, 0.9, 46, 0.7, 1, 0, 0, 1, 1),
    (12, 0.4, 35, 0.55, 35, 0.55, 1, 0, 0, 1, 1), (45, 0.45, 29, 0.55, 0, 0.0, 1, 0, 0, 1, 1), (13, 0.3, 0, 0.0, 36, 0.12, 1, 0, 0, 1, 1),
    (3, 0.4, 0, 0.0, 13, 0.05, 1, 0, 0, 1, 1), (29, 0.18, 0, 0.0, 8, 0.12, 1, 0, 0, 1, 1), (7, 0.45, 0, 0.0, 4, 0.55, 1, 0, 0, 1, 1),
    (28, 0.4, 0, 0.0, 18, 0.55, 1, 0, 0, 1, 1), (13, 0.45, 0, 0.0, 45, 0.55, 1, 0, 0, 1, 1), (36, 0.25, 0, 0.0, 45, 1.0, 1, 0, 0, 1, 1),
    (24, 0.18, 0, 0.0, 0, 0.0, 1, 0, 0, 1, 1), (4, 0.7, 36, 0.05, 201, 0.02, 1, 0, 0, 1, 1), (10, 0.7, 70, 0.05, 121, 0.0, 1, 0, 0, 1, 1),
    (8, 1.0, 36, 0.0, 7, 0.0, 1, 0, 0, 1, 0), (12, 0.55, 70, 0.05, 9, 0.05, 1, 0, 0, 1, 0), (45, 0.9, 46, 0.02, 12, 0.0, 1, 0, 0, 1, 0),
    (25, 0.7, 201, 0.02, 2, 1.0, 1, 0, 0, 1, 0), (28, 1.0, 46, 0.1, 18, 0.7, 1, 0, 0, 1, 0), (2, 0.7, 45, 0.12, 28, 1.0, 1, 0, 0, 1, 0),
    (3, 1.0, 120, 0.1, 0, 0.0, 1, 0, 0, 1, 0), (71, 0.55, 201, 0.05, 0, 0.0, 1, 0, 0, 1, 0), (8, 0.7, 18, 0.0, 28, 0.1, 1, 0, 0, 1, 0),
    (45, 0.7, 9, 0.05, 71, 0.12, 1, 0, 0, 1, 0), (3, 0.7, 5, 0.1, 5, 0.0, 1, 0, 0, 1, 0), (46, 0.9, 2, 0.1, 2, 0.1, 1, 0, 0, 1, 0),
    (3, 1.0, 2, 0.0, 13, 1.0, 1, 0, 0, 1, 0), (25, 0.55, 4, 0.02, 5, 0.9, 1, 0, 0, 1, 0), (200, 0.7, 4, 0.12, 8, 0.55, 1, 0, 0, 1, 0),
    (12, 0.7, 9, 0.02, 29, 1.0, 1, 0, 0, 1, 0), (121, 0.55, 8, 0.0, 70, 0.55, 1, 0, 0, 1, 0), (1, 0.7, 8, 0.05, 0, 0.0, 1, 0, 0, 1, 0),
    (25, 0.7, 19, 0.05, 0, 0.0, 1, 0, 0, 1, 0), (2, 0.9, 10, 0.55, 46, 0.1, 1, 0, 0, 1, 0), (2, 0.55, 1, 1.0, 2, 0.0, 1, 0, 0, 1, 0),
    (46, 0.7, 12, 0.7, 5, 0.12, 1, 0, 0, 1, 0), (2, 0.55, 3, 0.55, 13, 0.55, 1, 0, 0, 1, 0), (28, 0.9, 1, 1.0, 3, 0.55, 1, 0, 0, 1, 0),
    (200, 0.55, 18, 0.7, 45, 0.7, 1, 0, 0, 1, 0), (25, 0.9, 70, 0.7, 70, 0.0, 1, 0, 0, 1, 0), (1, 1.0, 28, 0.7, 3, 0.1, 1, 0, 0, 1, 0),
    (200, 0.7, 46, 0.7, 18, 0.0, 1, 0, 0, 1, 0), (24, 0.7, 29, 0.9, 10, 0.55, 1, 0, 0, 1, 0), (5, 0.7, 36, 1.0, 35, 0.7, 1, 0, 0, 1, 0),
    (9, 1.0, 71, 0.55, 0, 0.0, 1, 0, 0, 1, 0), (121, 1.0, 36, 1.0, 0, 0.0, 1, 0, 0, 1, 0), (18, 1.0, 0, 0.0, 200, 0.0, 1, 0, 0, 1, 0),
    (201, 0.7, 0, 0.0, 121, 0.05, 1, 0, 0, 1, 0), (24, 0.55, 0, 0.0, 10, 0.0, 1, 0, 0, 1, 0), (4, 0.55, 0, 0.0, 2, 0.55, 1, 0, 0, 1, 0),
    (201, 0.9, 0, 0.0, 4, 1.0, 1, 0, 0, 1, 0), (7, 1.0, 0, 0.0, 46, 0.7, 1, 0, 0, 1, 0), (200, 0.55, 0, 0.0, 28, 0.9, 1, 0, 0, 1, 0),
    (28, 0.7, 0, 0.0, 0, 0.0, 1, 0, 0, 1, 0), (4, 0.02, 36, 0.55, 36, 0.02, 1, 0, 1, 1, 1), (5, 0.0, 1, 0.0, 201, 0.02, 1, 0, 1, 1, 1),
    (4, 0.05, 0, 0.0, 19, 0.12, 1, 0, 1, 1, 1), (13, 0.05, 120, 0.02, 3, 0.12, 1, 0, 1, 1, 1), (2, 0.0, 46, 0.7, 5, 0.55, 1, 0, 1, 1, 1),
    (10, 0.1, 2, 0.05, 5, 1.0, 1, 0, 1, 1, 1), (1, 0.12, 45, 0.1, 28, 0.9, 1, 0, 1, 1, 1), (10, 0.02, 36, 0.0, 70, 0.55, 1, 0, 1, 1, 1),
    (9, 0.12, 29, 0.55, 0, 0.0, 1, 0, 1, 1, 1), (5, 0.0, 18, 0.0, 0, 0.0, 1, 0, 1, 1, 1), (19, 0.12, 28, 0.7, 70, 0.05, 1, 0, 0, 1, 1),
    (29, 0.7, 29, 1.0, 28, 0.02, 1, 0, 0, 1, 0), (13, 0.05, 120, 0.02, 45, 0.55, 1, 0, 0, 1, 1), (46, 1.0, 36, 0.0, 70, 1.0, 1, 0, 0, 1, 0),
    (12, 0.1, 45, 0.7, 28, 1.0, 1, 0, 0, 1, 1), (29, 0.55, 28, 0.55, 35, 1.0, 1, 0, 0, 1, 0), (12, 0.0, 3, 0.0, 3, 0.0, 0, 1, 0, 0, 0),
    (12, 0.1, 60, 0.0, 3, 0.0, 0, 1, 0, 0, 0), (1, 0.0, 3, 0.0, 1, 0.0, 0, 1, 0, 0, 0), (60, 0.6, 30, 0.0, 0, 0.0, 0, 1, 0, 0, 0),
    (3, 0.6, 1, 0.0, 60, 0.0, 0, 1, 0, 0, 0), (60, 0.6, 3, 0.0, 60, 0.0, 0, 1, 0, 0, 0), (12, 0.0, 30, 0.0, 30, 0.0, 0, 1, 0, 0, 0),
    (30, 0.0, 0, 0.0, 60, 0.0, 0, 1, 0, 0, 0), (3, 0.1, 30, 0.0, 0, 0.0, 0, 1, 1, 0, 0), (3, 0.6, 0, 0.0, 0, 0.0, 0, 1, 1, 0, 0),
    (12, 0.0, 60, 0.0, 30, 0.0, 0, 1, 1, 0, 0), (30, 0.1, 60, 0.0, 60, 0.0, 0, 1, 1, 0, 0), (30, 0.0, 3, 0.0, 1, 0.0, 0, 1, 1, 0, 0),
    (30, 0.1, 0, 0.0, 3, 0.0, 0, 1, 1, 0, 0), (30, 0.6, 0, 0.0, 3, 0.0, 0, 1, 1, 0, 0), (3, 0.0, 1, 0.0, 1, 0.0, 0, 1, 1, 0, 0),
    (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (1, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (1, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 0, 0),
    (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 0, 0), (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (2, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (2, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 0, 0), (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 0, 0), (3, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (3, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 0, 0),
    (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (5, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (5, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 0, 0),
    (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 0, 0), (9, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (9, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (9, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 0, 0), (9, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 0, 0), (15, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (15, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 0, 0), (15, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 0, 0), (15, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 0, 0),
    (6, 0.0, 30, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (3, 0.6, 0, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (2, 0.0, 0, 0.0, 0, 0.0, 1, 1, 0, 1, 0),
    (3, 0.1, 30, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (12, 0.0, 3, 0.0, 3, 0.0, 1, 1, 0, 1, 0), (30, 0.0, 0, 0.0, 30, 0.0, 1, 1, 0, 1, 0),
    (60, 0.1, 3, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (2, 0.1, 30, 0.0, 60, 0.0, 1, 1, 0, 1, 0), (2, 0.6, 60, 0.0, 30, 0.0, 1, 1, 1, 1, 0),
    (60, 0.1, 0, 0.0, 1, 0.0, 1, 1, 1, 1, 0), (30, 0.0, 1, 0.0, 3, 0.0, 1, 1, 1, 1, 0), (6, 0.6, 1, 0.0, 1, 0.0, 1, 1, 1, 1, 0),
    (12, 0.0, 0, 0.0, 30, 0.0, 0, 1, 1, 1, 0), (6, 0.0, 30, 0.0, 1, 0.0, 1, 1, 1, 1, 0), (3, 0.1, 0, 0.0, 60, 0.0, 1, 1, 1, 1, 0),
    (6, 0.0, 1, 0.0, 30, 0.0, 1, 1, 1, 1, 0), (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (1, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (1, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 1, 0), (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 1, 0), (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (2, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (2, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 1, 0), (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 1, 0),
    (3, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (3, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (3, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 1, 0),
    (3, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 1, 0), (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (5, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (5, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 1, 0), (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 1, 0), (9, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0),
    (9, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (9, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 1, 0), (9, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 1, 0),
    (15, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (15, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 1, 0), (15, 0.0, 0, 0.0, 2, 0.0, 0, 0, 0, 1, 0),
    (15, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 1, 0), (1, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 1, 0), (1, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 0, 0),
    (1, 0.0, 5, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (1, 0.0, 12, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (1, 0.0, 20, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (1, 0.0, 23, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (1, 0.0, 25, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (1, 0.0, 26, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (1, 0.0, 28, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (1, 0.0, 32, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (1, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (1, 0.0, 80, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (1, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 1, 0), (1, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 0, 0),
    (1, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (1, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0, 0), (1, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 1, 0),
    (1, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 0, 0), (3, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 0, 0),
    (3, 0.0, 5, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 12, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 20, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (3, 0.0, 23, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 25, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 26, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (3, 0.0, 28, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 32, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (3, 0.0, 80, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 0, 0),
    (3, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (3, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0, 0), (3, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 1, 0),
    (3, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 0, 0), (7, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 0, 0),
    (7, 0.0, 5, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 12, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 20, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (7, 0.0, 23, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 25, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 26, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (7, 0.0, 28, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 32, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (7, 0.0, 80, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 0, 0),
    (7, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (7, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0, 0), (7, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 1, 0),
    (7, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 0, 0), (10, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 1, 0), (10, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 0, 0),
    (10, 0.0, 5, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (10, 0.0, 12, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (10, 0.0, 20, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (10, 0.0, 23, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (10, 0.0, 25, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (10, 0.0, 26, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (10, 0.0, 28, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (10, 0.0, 32, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (10, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (10, 0.0, 80, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (10, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 1, 0), (10, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 0, 0),
    (10, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (10, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0, 0), (10, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 1, 0),
    (10, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 0, 0), (16, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 1, 0), (16, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 0, 0),
    (16, 0.0, 5, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (16, 0.0, 12, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (16, 0.0, 20, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (16, 0.0, 23, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (16, 0.0, 25, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (16, 0.0, 26, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (16, 0.0, 28, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (16, 0.0, 32, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (16, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (16, 0.0, 80, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (16, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 1, 0), (16, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 0, 0),
    (16, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (16, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0, 0), (16, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 1, 0),
    (16, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 0, 0), (25, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 1, 0), (25, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 0, 0),
    (25, 0.0, 5, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (25, 0.0, 12, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (25, 0.0, 20, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (25, 0.0, 23, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (25, 0.0, 25, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (25, 0.0, 26, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (25, 0.0, 28, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (25, 0.0, 32, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (25, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (25, 0.0, 80, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (25, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 1, 0), (25, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 0, 0),
    (25, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (25, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0, 0), (25, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 1, 0),
    (25, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 0, 0), (50, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 1, 0), (50, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0, 0, 0),
    (50, 0.0, 5, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (50, 0.0, 12, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (50, 0.0, 20, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (50, 0.0, 23, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (50, 0.0, 25, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (50, 0.0, 26, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (50, 0.0, 28, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (50, 0.0, 32, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (50, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0, 1, 0),
    (50, 0.0, 80, 0.0, 0, 0.0, 0, 1, 0, 1, 0), (50, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 1, 0), (50, 0.0, 24, 0.0, 24, 0.0, 0, 1, 0, 0, 0),
    (50, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 1, 0), (50, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0, 0), (50, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 1, 0),
    (50, 0.0, 30, 0.0, 3, 0.0, 0, 1, 0, 0, 0), (1, 1.0, 60, 0.0, 4, 1.0, 1, 0, 0, 1, 0), (1, 1.0, 30, 0.0, 2, 1.0, 1, 0, 0, 1, 0),
    (1, 1.0, 90, 0.0, 8, 0.9, 1, 0, 0, 1, 0), (1, 1.0, 4, 1.0, 60, 0.0, 1, 0, 0, 1, 0), (1, 1.0, 2, 1.0, 30, 0.0, 1, 0, 0, 1, 0),
    (1, 1.0, 4, 1.0, 0, 0.0, 1, 0, 0, 1, 0), (1, 1.0, 0, 0.0, 4, 1.0, 1, 0, 0, 1, 0), (1, 1.0, 60, 0.0, 30, 0.0, 1, 0, 0, 1, 1),
    (1, 1.0, 45, 0.0, 90, 0.05, 1, 0, 0, 1, 1), (1, 1.0, 70, 0.0, 0, 0.0, 1, 0, 0, 1, 0), (1, 1.0, 60, 0.0, 9, 0.0, 1, 0, 0, 1, 0),
    (2, 1.0, 60, 0.0, 4, 1.0, 1, 0, 0, 1, 0), (2, 1.0, 30, 0.0, 2, 1.0, 1, 0, 0, 1, 0), (2, 1.0, 90, 0.0, 8, 0.9, 1, 0, 0, 1, 0),
    (2, 1.0, 4, 1.0, 60, 0.0, 1, 0, 0, 1, 0), (2, 1.0, 2, 1.0, 30, 0.0, 1, 0, 0, 1, 0), (2, 1.0, 4, 1.0, 0, 0.0, 1, 0, 0, 1, 0),
    (2, 1.0, 0, 0.0, 4, 1.0, 1, 0, 0, 1, 0), (2, 1.0, 60, 0.0, 30, 0.0, 1, 0, 0, 1, 1), (2, 1.0, 45, 0.0, 90, 0.05, 1, 0, 0, 1, 1),
    (2, 1.0, 70, 0.0, 0, 0.0, 1, 0, 0, 1, 0), (2, 1.0, 60, 0.0, 9, 0.0, 1, 0, 0, 1, 0), (4, 1.0, 60, 0.0, 4, 1.0, 1, 0, 0, 1, 0),
    (4, 1.0, 30, 0.0, 2, 1.0, 1, 0, 0, 1, 0), (4, 1.0, 90, 0.0, 8, 0.9, 1, 0, 0, 1, 0), (4, 1.0, 4, 1.0, 60, 0.0, 1, 0, 0, 1, 0),
    (4, 1.0, 2, 1.0, 30, 0.0, 1, 0, 0, 1, 0), (4, 1.0, 4, 1.0, 0, 0.0, 1, 0, 0, 1, 0), (4, 1.0, 0, 0.0, 4, 1.0, 1, 0, 0, 1, 0),
    (4, 1.0, 60, 0.0, 30, 0.0, 1, 0, 0, 1, 1), (4, 1.0, 45, 0.0, 90, 0.05, 1, 0, 0, 1, 1), (4, 1.0, 70, 0.0, 0, 0.0, 1, 0, 0, 1, 0),
    (4, 1.0, 60, 0.0, 9, 0.0, 1, 0, 0, 1, 0), (8, 1.0, 60, 0.0, 4, 1.0, 1, 0, 0, 1, 0), (8, 1.0, 30, 0.0, 2, 1.0, 1, 0, 0, 1, 0),
    (8, 1.0, 90, 0.0, 8, 0.9, 1, 0, 0, 1, 0), (8, 1.0, 4, 1.0, 60, 0.0, 1, 0, 0, 1, 0), (8, 1.0, 2, 1.0, 30, 0.0, 1, 0, 0, 1, 0),
    (8, 1.0, 4, 1.0, 0, 0.0, 1, 0, 0, 1, 0), (8, 1.0, 0, 0.0, 4, 1.0, 1, 0, 0, 1, 0), (8, 1.0, 60, 0.0, 30, 0.0, 1, 0, 0, 1, 1),
    (8, 1.0, 45, 0.0, 90, 0.05, 1, 0, 0, 1, 1), (8, 1.0, 70, 0.0, 0, 0.0, 1, 0, 0, 1, 0), (8, 1.0, 60, 0.0, 9, 0.0, 1, 0, 0, 1, 0),
)


@dataclass
class Tree:
    """A binary decision tree as nested tuples (feature, value, below, at or above); a leaf is its class."""

    root: object

    def keeps(self, row: tuple) -> bool:
        node = self.root
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] < node[1] else node[3]
        return bool(node)


def train_tree(table: tuple = LABELLED, depth: int = 14) -> Tree:
    """Grow by the split of least Gini impurity until nodes are pure; ties go to the earlier feature and lower value."""
    x = np.array([r[:-1] for r in table], dtype=float)
    y = np.array([r[-1] for r in table], dtype=float)

    def impurity(part: np.ndarray) -> float:
        p = part.mean()
        return len(part) * p * (1 - p)

    def grow(rows: np.ndarray, left: int) -> object:
        labels = y[rows]
        if left == 0 or labels.min() == labels.max():
            return int(labels.mean() >= 0.5)
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[rows, f])
            for v in (values[1:] + values[:-1]) / 2:
                below = x[rows, f] < v
                cost = impurity(labels[below]) + impurity(labels[~below])
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, f, float(v), below)
        if best is None:
            return int(labels.mean() >= 0.5)
        _, f, v, below = best
        return (f, v, grow(rows[below], left - 1), grow(rows[~below], left - 1))

    return Tree(grow(np.arange(len(x)), depth))


@dataclass
class Block:
    text: str
    words: int
    linked: int
    main: bool
    boilerplate: bool
    heading: bool


def text_blocks(page: str) -> list[Block]:
    """Flat text blocks of a page, in page order."""
    blocks: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    # open containers: (tag, says main, says boilerplate, hidden)
    stack: list[tuple[str, bool, bool, bool]] = []
    links, heading = 0, False

    def close_block() -> None:
        if not pieces:
            return
        whole = SPACE.sub(" ", html.unescape("".join(p for p, _ in pieces))).strip()
        if whole:
            linked = sum(len(html.unescape(p).split()) for p, is_link in pieces if is_link)
            words = len(whole.split(" "))
            main = boilerplate = False
            for tag, says_main, says_boilerplate, _ in stack:
                if says_main:
                    main, boilerplate = True, boilerplate and tag not in MAIN_CONTAINERS
                # a header of the page is boilerplate, one of an article is not
                boilerplate = boilerplate or says_boilerplate or (tag == "header" and not main)
            blocks.append(Block(whole, words, min(linked, words), main, boilerplate, heading))
        pieces.clear()

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            if not any(s[3] for s in stack):
                pieces.append((page[at:], links > 0))
            break
        if m.start() > at and not (stack and stack[-1][3]):
            pieces.append((page[at : m.start()], links > 0))
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        ends, attributes = bool(m.group(1)), m.group(3) or ""
        if tag in BLOCK_TAGS or tag in RAW_TAGS:
            close_block()
        if tag in RAW_TAGS:
            if not ends and not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if tag == "head" and end is None:
                    continue  # a head that is never closed ends where the body begins
                at = end.end() if end else n
            continue
        if tag == "a":
            links = max(0, links - 1) if ends else links + 1
        elif tag in CONTAINERS:
            links = 0
            if ends:
                if any(s[0] == tag for s in stack):
                    while stack.pop()[0] != tag:
                        pass
            else:
                names = " ".join(next(filter(None, g), "") for g in NAMED.findall(attributes))
                hidden = bool(HIDDEN.search(attributes)) or bool(stack and stack[-1][3])
                says_boilerplate = tag in BOILERPLATE_CONTAINERS or (tag not in ("body", "article", "main") and bool(BOILERPLATE_NAMES.search(names)))
                says_main = tag in MAIN_CONTAINERS or (tag in ("div", "section") and not says_boilerplate and bool(MAIN_NAMES.search(names)))
                stack.append((tag, says_main, says_boilerplate, hidden))
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            heading = not ends
    close_block()
    return blocks


def block_rows(blocks: list[Block]) -> list[tuple]:
    """Features of every block (see ``FEATURES``)."""
    size = [(0, 0.0), *[(b.words, b.linked / b.words) for b in blocks], (0, 0.0)]
    main_page = int(any(b.main for b in blocks))
    return [
        (*size[i + 1], *size[i], *size[i + 2], int(b.main), int(b.boilerplate), int(b.heading), main_page) for i, b in enumerate(blocks)
    ]


def main_text(page: str | None, tree: Tree) -> str:
    blocks = text_blocks(page or "")
    return "\n".join(b.text for b, row in zip(blocks, block_rows(blocks), strict=True) if tree.keeps(row))


def extract_pages(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``; one pass, no shuffle."""
    small_batches(pages.sparkSession)
    tree = tree or train_tree()
    chosen = pages.select(pages["page_id"], pages["url"], pages["html"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [main_text(p, tree) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
                )

    id_type = chosen.schema["page_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars bigint")
