"""Main content of web pages and feed texts, by composite text density over a tolerant DOM."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veredas.functions.text import fold_py
from veredas.session import materialize

HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^<>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\s[^<>]*)?)/?>|<![^<>]*>|<\?[^<>]*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*)?\Z")
ENTITY = re.compile(r"&(?:#\d+|#[xX][0-9a-fA-F]+|[a-zA-Z]+\d*);?")
SPACES = re.compile(r"\s+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote center div dl dt dd fieldset figure footer form h1 h2 h3 h4 h5 h6 header li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
)
#: A start tag ends these open elements, up to the first of the barriers.
ENDS = {
    "li": (frozenset({"li", "p"}), frozenset({"ul", "ol", "div", "table", "article", "main", "section", "td"})),
    "tr": (frozenset({"tr", "td", "th", "p"}), frozenset({"table", "tbody", "thead", "tfoot", "div"})),
    "td": (frozenset({"td", "th", "p"}), frozenset({"tr", "table", "div"})),
    "th": (frozenset({"td", "th", "p"}), frozenset({"tr", "table", "div"})),
}
OTHER_BLOCK = (frozenset({"p"}), frozenset({"div", "table", "td", "li", "article", "main", "section", "aside", "body"}))


def blank_hidden(text: str) -> str:
    """Scripts, styles and comments taken out, line breaks kept."""
    return HIDDEN.sub(lambda m: "\n" * m.group().count("\n"), text) if "<" in text else text


def decode(text: str) -> str:
    return html.unescape(text) if "&" in text else text


def visible_lines(text: str) -> list[str]:
    """The visible text of each line of ``text`` split at line feeds: no tags, entities decoded, no script content."""
    text = blank_hidden(text)
    if "<" in text:
        text = TAG.sub(lambda m: "\n" * m.group().count("\n") or " ", text)
    return [decode(line) for line in text.split("\n")]


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    first: int
    last: int
    chars: int = 0
    link_chars: int = 0
    tags: int = 0
    link_tags: int = 0
    children: list[int] = field(default_factory=list)


def parse(text: str) -> tuple[list[Node], list[list[tuple[int, str, bool]]]]:
    """Nodes in document order (0 is the root), and for each line its pieces (node, text, inside a link)."""
    text = blank_hidden(text)
    nodes = [Node("#root", -1, 0, 0)]
    stack = [0]
    pieces: list[list[tuple[int, str, bool]]] = [[]]
    links = 0

    def put(raw: str) -> None:
        parts = raw.split("\n")
        for i, part in enumerate(parts):
            if i:
                pieces.append([])
            if part.strip():
                shown = decode(part)
                size = len("".join(shown.split()))
                pieces[-1].append((stack[-1], shown, links > 0))
                nodes[stack[-1]].chars += size
                if links:
                    nodes[stack[-1]].link_chars += size

    def close(upto: int) -> None:
        nonlocal links
        while len(stack) > upto:
            node = nodes[stack.pop()]
            node.last = len(pieces) - 1
            links -= node.tag == "a"

    at = 0
    for match in TAG.finditer(text):
        if match.start() > at:
            put(text[at : match.start()])
        at = match.end()
        tag = (match.group(2) or match.group(5) or "").lower()
        if "\n" in match.group():
            pieces.extend([] for _ in range(match.group().count("\n")))
        if not tag:
            continue
        if match.group(1) or match.group(4):
            for i in range(len(stack) - 1, 0, -1):
                if nodes[stack[i]].tag == tag:
                    close(i)
                    break
            continue
        if tag in BLOCKS:
            ending, barrier = ENDS.get(tag, OTHER_BLOCK)
            for i in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[i]].tag
                if open_tag in barrier and open_tag not in ending:
                    break
                if open_tag in ending:
                    close(i)
        if tag == "a" and links:  # links don't nest
            for i in range(len(stack) - 1, 0, -1):
                if nodes[stack[i]].tag == "a":
                    close(i)
                    break
        node = Node(tag, stack[-1], len(pieces) - 1, len(pieces) - 1)
        nodes[stack[-1]].children.append(len(nodes))
        if tag not in VOID:
            stack.append(len(nodes))
            links += tag == "a"
        nodes.append(node)
    if at < len(text):
        put(text[at:])
    close(0)
    for i in range(len(nodes) - 1, 0, -1):  # children come after their parents
        node, parent = nodes[i], nodes[nodes[i].parent]
        parent.chars += node.chars
        parent.link_chars += node.link_chars
        parent.tags += node.tags + 1
        parent.link_tags += node.link_tags + (node.tag == "a")
        parent.last = max(parent.last, node.last)
    return nodes, pieces


def density(node: Node, body: Node) -> float:
    """Composite text density: characters for each tag, lowered by the share of link characters and link tags."""
    if not node.chars:
        return 0.0
    tags, links, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
    plain = max(node.chars - node.link_chars, 1)
    base = math.log(node.chars / plain * node.link_chars + body.link_chars / max(body.chars, 1) * node.chars + math.e)
    ratio = max(node.chars / links * tags / link_tags, 1.0)
    return node.chars / tags * math.log(ratio + 1e-9, max(base, 1.0001)) if ratio > 1 else 0.0


# Furniture inside an article, as patterns over folded text with spaces collapsed.
WITHIN = [
    r"publicad[oa] (?:el )?\d",
    r"actualizad[oa] (?:el )?\d",
    r"published (?:on )?",
    r"compartid[oa] [\d.]+ veces",
    r"[\d.,]+ lecturas?, [\d.,]+ comentarios?",
    r"enviar por correo ·",
    r"comparta esta nota",
    r"compartilhe",
    r"share this",
    r"¿le sirvio esta pagina",
    r"(?:lea|vea|mire|leia|veja|read) (?:tambien|tambem|also|mas) ?:",
]
# Furniture that ends an article in a text without markup.
AFTER = [
    r"comentarios de (?:los )?lectores",
    r"(?:publicaciones|noticias|entradas) recientes",
    r"lo mas leido",
    r"(?:otras|mas) noticias",
    r"le puede interesar",
    r"¿tiene una denuncia",
    r"prohibida la reproduccion",
    r"defensor del lector",
    r"carrera \d+ numero",
    r"linea de atencion",
    r"terminos de uso",
    r".*©.*derechos reservados",
    r"suscribase a ",
    r"reciba el resumen",
    r"al continuar en este portal",
    r"valoramos su privacidad",
    r"usamos cookies",
    r".* guarda pequenos archivos en su equipo",
    r"comprobando que la visita",
    r"inicio > ",
]
# Endings of feed entries.
FEED = [r"la entrada se publico primero en", r"siga leyendo en", r"mas notas como esta ?:", r"the post .* appeared first", r"comprobando que la visita"]
WITHIN_RE, AFTER_RE, FEED_RE = (re.compile("|".join(f"(?:{p})" for p in ps)) for ps in (WITHIN, AFTER, FEED))
CAP = r"[A-ZÁÉÍÓÚÑÜ][\w'-]*"
BYLINE = re.compile(rf"(?:Por|POR|By|BY)\s+{CAP}(?:\s+{CAP}){{1,4}}(?:,.*)?$")
PAGE = re.compile(r"<(?:!doctype|html|head|body)\b", re.I)


def plain_form(text: str) -> str:
    return SPACES.sub(" ", fold_py(text)).strip()


NEVER = re.compile(r"(?!)")


@dataclass(frozen=True)
class Phrases:
    """Furniture by its wording: inside an article, at its end, and at the end of a feed entry."""

    within: re.Pattern[str] = WITHIN_RE
    after: re.Pattern[str] = AFTER_RE
    feed: re.Pattern[str] = FEED_RE

    def is_within(self, line: str, form: str) -> bool:
        """Bylines, dates, share prompts and links to other items, which stand between the lines of an article."""
        return bool(self.within.match(form) or BYLINE.match(line.strip()))


KNOWN, NONE = Phrases(), Phrases(NEVER, NEVER, NEVER)


#: Paragraphs of a short article may be thinner than the page's long notices.
THIN = 0.4


def article_node(nodes: list[Node], headline: int | None) -> int:
    """The subtree that holds the article.

    With a headline: the innermost node around it that has another child of at least ``THIN`` times the density of the thinnest
    node between it and the body. Else, or if none is: the node with the greatest sum of its children's densities (around the headline, if
    there is one).
    """
    body = nodes[0]
    dense = [density(n, body) for n in nodes]
    sums = [sum(dense[k] for k in n.children) for n in nodes]
    if headline is None:
        return max(range(len(nodes)), key=sums.__getitem__)
    path, i = [], headline
    while i >= 0:
        path.append(i)
        i = nodes[i].parent
    on_path = set(path)
    threshold = THIN * min([dense[i] for i in path[1:] if dense[i] > 0], default=0.0)
    for i in path[1:]:
        if any(dense[k] >= threshold for k in nodes[i].children if k not in on_path and dense[k] > 0):
            return i
    return max(path, key=sums.__getitem__)


def above_header(pieces: list[list[tuple[int, str, bool]]], shown: list[str], phrases: Phrases) -> int | None:
    last = None
    for line, visible in zip(pieces, shown):
        if visible.strip():
            if phrases.is_within(visible, plain_form(visible)):
                return last
            last = line[0][0]
    return None


def main_lines(text: str | None, title: str | None, phrases: Phrases = KNOWN) -> list[tuple[int, str]]:
    """(line number from 1, visible text) of the article's own lines."""
    return lines_of(text, title, phrases)[1]


def lines_of(text: str | None, title: str | None, phrases: Phrases) -> tuple[list[str], list[tuple[int, str]]]:
    """The visible text of every line, and (line number from 1, visible text) of those of the article."""
    if not text:
        return [], []
    wanted = plain_form(title) if title else ""
    if PAGE.search(text):
        nodes, pieces = parse(text)
        shown = ["".join(s for _, s, _ in line) for line in pieces]
        headline = next((i for i, n in enumerate(nodes) if n.tag == "h1" and n.chars), None)
        if headline is None and wanted:
            headline = next((p[0][0] for p, s in zip(pieces, shown) if p and plain_form(s) == wanted), None)
        if headline is None:  # the line above the first byline or date
            headline = above_header(pieces, shown, phrases)
        root = article_node(nodes, headline)
        inside = [False] * len(nodes)
        inside[root] = True
        for i in range(root + 1, len(nodes)):
            inside[i] = inside[nodes[i].parent]
        found = []
        for number, (line, visible) in enumerate(zip(pieces, shown), 1):
            if not visible.strip() or not inside[line[0][0]]:
                continue
            linked = sum(len(s) for _, s, link in line if link)
            form = plain_form(visible)
            if 2 * linked > len(visible) or phrases.is_within(visible, form) or phrases.after.match(form):
                continue
            found.append((number, visible))
        return shown, found
    shown = visible_lines(text)
    forms = [plain_form(s) for s in shown]
    start = next((i for i, f in enumerate(forms) if wanted and f == wanted), None)
    if start is None and any(phrases.after.match(f) for f in forms):  # a page as plain text, without its title
        header = next((i for i, (s, f) in enumerate(zip(shown, forms)) if phrases.is_within(s, f)), None)
        before = [i for i in range(header or 0) if forms[i]]
        body = (i for i, f in enumerate(forms) if len(f.split()) > 4 and "|" not in f and not phrases.after.match(f))
        start = before[-1] if before else next(body, None)
    last = len(shown)
    if start is not None:
        last = next((i for i in range(start, len(shown)) if phrases.after.match(forms[i])), last)
    return shown, [
        (i + 1, shown[i])
        for i in range(start or 0, last)
        if forms[i] and not phrases.is_within(shown[i], forms[i]) and not phrases.feed.match(forms[i])
    ]


LINES = (
    "pos long, source string, item long, numbers array<int>, texts array<string>, marks array<struct<key:long,opening:long,label:long>>, "
    "every array<struct<key:long,opening:long,label:long>>"
)
#: Words by which the opening of a line is known, and letters that a label before a colon has at most.
OPENING_WORDS, LABEL_LETTERS = 4, 40
LETTER_RUNS = re.compile(r"[a-z]+")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def marks_of(visible: str) -> tuple[int, int | None, int | None] | None:
    """Hashes of a line's letters, of its first words and of the label before its colon; None without letters."""
    form = fold_py(visible)
    words = LETTER_RUNS.findall(form)
    if not words:
        return None
    label, colon, rest = form.partition(":")
    label = "".join(LETTER_RUNS.findall(label)) if colon and rest.strip() else ""
    opening = " ".join(words[:OPENING_WORDS]) if len(words) >= OPENING_WORDS else ""
    return _hash("".join(words)), _hash(opening) if opening else None, _hash(label) if 0 < len(label) <= LABEL_LETTERS else None


def _lines(phrases: Phrases, labels: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple | None] = {}

        def marks(line: str) -> tuple | None:
            if line not in known:
                if len(known) > 50_000:
                    known.clear()
                found = marks_of(line)
                known[line] = found if labels or found is None else (*found[:2], None)
            return known[line]

        for batch in batches:
            numbers, texts, own, every = [], [], [], []
            for text, title in zip(batch["text"], batch["title"]):
                shown, chosen = lines_of(text, title, phrases)
                numbers.append([n for n, _ in chosen])
                texts.append([v for _, v in chosen])
                own.append([marks(v) or (None, None, None) for _, v in chosen])
                every.append([*{marks(v) for v in shown} - {None}])
            yield batch[["pos", "source", "item"]].assign(numbers=numbers, texts=texts, marks=own, every=every)

    return emit


def main_content_lines(
    rows: DataFrame,
    *,
    pos: str = "pos",
    source: str = "source_id",
    item: str = "id",
    text: str = "raw_text",
    title: str = "title",
    phrases: bool = True,
    least_items: int = 10,
    least_share: float = 0.1,
    least_label_share: float = 0.02,
) -> DataFrame:
    """(pos, line_no, line): the article's own lines of each page, feed entry or plain text.

    Each text by itself gives its lines as :func:`extract_main_content` does; then what a source repeats is taken out of them, as
    no article's own line comes back in many items: lines whose letters come back in at least ``least_items`` items and ``least_share`` of the
    source's, and lines that open with the words with which such a line of any source opens. Without ``phrases`` no
    wording is known beforehand; lines with a label before a colon that comes back in ``least_label_share`` of the source's items go, too.

    All counts are over all rows, first by item, so that no source is ever one group. Null or empty texts give no lines; rows with a null source or
    item are not counted, and those with a null source lose lines by their opening alone; repeated rows count once and each have their lines; an empty
    table gives none; other columns are ignored.
    """
    chosen = rows.select(
        F.col(pos).cast("long").alias("pos"),
        F.col(source).cast("string").alias("source"),
        F.when(F.col(item).isNotNull(), F.xxhash64(F.col(item).cast("string"))).alias("item"),
        F.col(text).cast("string").alias("text"),
        F.col(title).cast("string").alias("title"),
    )
    kept = materialize(chosen.mapInPandas(_lines(KNOWN if phrases else NONE, not phrases), LINES), "content-lines")
    counted = kept.where("source is not null and item is not null").select("source", "item", F.explode("every").alias("m"))
    items = chosen.where("source is not null and item is not null").groupBy("source").agg(F.count_distinct("item").alias("items"))

    def repeated(mark: str, share: float, *also: Column) -> DataFrame:
        """(source, mark) of what comes back in enough items of the source."""
        of_item = counted.select("source", "item", F.col(f"m.{mark}").alias(mark), "m.opening") if also else counted.select("source", "item", f"m.{mark}")
        of_item = of_item.where(F.col(mark).isNotNull()).groupBy("source", "item", mark).agg(*(also or [F.lit(1).alias("one")]))
        of_source = of_item.groupBy("source", mark).agg(F.count("*").alias("support"), *also)
        return of_source.join(items, "source").where((F.col("support") >= least_items) & (F.col("support") >= F.col("items") * share))

    lines = materialize(repeated("key", least_share, F.min("opening").alias("opening")).select("source", "key", "opening"), "repeated-lines")
    found = kept.select("pos", "source", F.explode(F.arrays_zip("numbers", "texts", "marks")).alias("l"))
    found = found.select("pos", "source", F.col("l.numbers").cast("long").alias("line_no"), F.col("l.texts").alias("line"), "l.marks.key", "l.marks.opening", "l.marks.label")
    found = found.join(lines.select("source", "key"), ["source", "key"], "left_anti")
    found = found.join(lines.select("opening").where("opening is not null").distinct(), "opening", "left_anti")
    if not phrases:
        found = found.join(repeated("label", least_label_share).select("source", "label"), ["source", "label"], "left_anti")
    return found.select("pos", "line_no", "line")


MAIN = "pos long, line_numbers array<long>, main_text string"


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        lines = [main_lines(text, title) for text, title in zip(batch["text"], batch["title"])]
        yield pd.DataFrame(
            {
                "pos": batch["pos"],
                "line_numbers": [[n for n, _ in x] for x in lines],
                "main_text": ["\n".join(s.strip() for _, s in x) for x in lines],
            }
        )


def extract_main_content(rows: DataFrame, *, pos: str = "pos", text: str = "raw_text", title: str = "title") -> DataFrame:
    """(pos, line_numbers, main_text): the article's own lines of each page, feed entry or plain text, and their text.

    Pages are parsed to a tree that bears with unclosed and stray tags; the subtree is chosen by composite text density
    (:func:`article_node`), and lines that are mostly links or furniture inside the article are dropped from it. A text
    without page markup has lines for nodes: it begins at its title, if that is one of its lines, and ends at the first
    line of the page's foot. Null or empty texts, and texts without an article, give an empty list; the text is
    never cut; rows are independent, repeated ones give repeated results, and other columns are ignored.
    """
    return rows.select(
        F.col(pos).cast("long").alias("pos"), F.col(text).cast("string").alias("text"), F.col(title).cast("string").alias("title")
    ).mapInPandas(_extract, MAIN)
