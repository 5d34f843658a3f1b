"""Main text of web pages by two passes over their blocks.

First pass: a block is decided by where it stands (menus, footers, notices, adverts, forms,
comments are out), by link density, stop-word density and length; short blocks stay
undecided. Inside <article> or <main> a block is judged one step better, but link-dense
list items are bad there too, and a paragraph that is mostly link is left to the second pass;
text outside is judged like that of a page without them. Names of menus and share bars give
way to prose where an article's own names stand beside them. Second pass: an undecided block
inherits the label of its nearest decided neighbours (a heading that of what follows it),
those inside a region and those outside each among themselves.

Stop words are those known beforehand and the frequent short words of the pages of the
same declared language, learnt from all of them. Where long blocks without them outweigh the good ones, the
language or its spelling isn't known, and they count as good.

Pages are parsed once: what may be text is written with the counts of its words, and labelled when the stop words are known.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

SHORT, LONG = 70, 200  # characters
LOW_STOPS, HIGH_STOPS, FEW_LINKS, MOST_LINKS = 0.20, 0.30, 0.2, 0.5

RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "title", "xmp", "canvas"}
FOREIGN = {"svg", "math"}
#: Elements whose start closes an open one of the same kind, and those within which that one must stand.
CLOSED_BY = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
OPEN_DEPTH = 100  # that is looked through for it
OUT = {"nav", "footer", "aside", "form", "head", "button", "select", "dialog", "menu", "label", "input", "legend", "fieldset", "audio", "video"}
REGION = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
PLACES_OUT = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form"}
# Parts of class names and ids. Those of the first kind are out whatever stands beside them (comment-body, ad-content);
# those of the second kind too, but beside a name of an article's parts they only raise the bar for the text.
NAMES_OUT = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr popup modal overlay newsletter "
    "subscribe signup sidebar sidebars footer comment comments commentlist disqus respond reply replies taboola outbrain paywall".split()
)
NAMES_DOUBTFUL = set(
    "banner promotion notice notices notification alert subscription related recommended widget widgets pager pagination hidden masthead toolbar "
    "login search skip tags nav navbar navigation menu menus breadcrumb breadcrumbs social share sharing".split()
)
NAMES_IN = set("article content entry post story main body text page".split())
LAYOUT = set("with has no without not".split())  # a name with such a part tells of the layout: has-sidebar
# Frequent function words known beforehand; `learn` adds those of the pages.
STOPS = set(
    "the of and to in a is that it for was on with as are be this by at from or an not have but which you his her they had were "
    "der die und das in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis "
    "le la les de des et à un une du en que qui dans pour pas sur au avec il elle est par ce se son plus ne ou sont nous vous mais cette aux "
    "el los las del y que en un una por con para su es al lo como más o pero sus se no le ya este sí porque esta entre cuando muy sin sobre también".split()
)

TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*+=\s*+("[^"]*"|'[^']*'|[^\s>"']+)""")
TELLING = re.compile(r"class|id|role|aria-hidden|style|hidden", re.I)  # attributes that `standing` looks at
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")  # commentBody has two parts
HTML_TAG = re.compile(r"<html\b([^>]*+)", re.I)
LANGUAGE = re.compile(r"""\blang\s*=\s*["']?([a-z]{2,3})\b""", re.I)
ENDS = re.compile(r"^[\W\d_]+|[\W\d_]+$")

# A word of at most SHORT_WORD letters is learnt if it is FREQUENT among the words of its language's pages and on LEAST_PAGES of them.
SHORT_WORD, FREQUENT, LEAST_PAGES = 6, 1 / 250, 10
# A page's blocks but for those that are out: their texts, a line each, and for each its link_chars and MARKS. Counts of words are
# those of all pages that were parsed at once, in the row of the first one.
MARKS = ("doubtful", "region", "heading", "paragraph")
COUNTS = "languages array<string>, words array<string>, n array<long>, pages array<long>"
PARSED = f"page_id long, url string, language string, text string, told array<long>, {COUNTS}"


@dataclass
class Block:
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    link_chars: int = 0
    out: bool = False
    doubtful: bool = False
    region: bool = False
    heading: bool = False
    paragraph: bool = False
    text: str = ""
    label: str = ""


def standing(tag: str, rest: str, in_region: bool) -> tuple[bool, bool]:
    """Whether an element is no part of an article, by its tag and attributes; whether its names speak both
    for and against that."""
    if tag in OUT or (tag == "header" and not in_region):
        return True, False
    if not rest or tag in REGION or tag in ("html", "body") or not TELLING.search(rest):
        return False, False
    told = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(rest)}
    found = {k: v.lower() for k, v in told.items()}
    if found.get("role") in PLACES_OUT or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True, False
    if re.search(r"(?:^|\s)hidden(?:\s|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", rest.lower())):
        return True, False
    names = names_of(told)
    doubtful = bool(names & NAMES_DOUBTFUL)
    out = bool(names & NAMES_OUT) or doubtful and not names & NAMES_IN
    return out, doubtful and not out


def names_of(attributes: dict[str, str]) -> set[str]:
    """The parts of an element's class names and id, but for those that tell of the layout."""
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    parts = ({p.lower() for p in NAME.findall(name)} for name in named)
    return set().union(*[p for p in parts if not p & LAYOUT])


def tokens(page: str) -> Iterator[tuple[str, str, str, str]]:
    """(kind, tag, attributes, text): kinds are text, open and close. Comments, declarations and
    the contents of raw elements are left out. Linear: after one tag whose quotes don't close,
    tags end at the next >, quoted or not."""
    at, end, pattern = 0, len(page), TAG
    while at < end:
        here = page.find("<", at)
        if here < 0:
            yield "text", "", "", page[at:]
            return
        if here > at:
            yield "text", "", "", page[at:here]
        if page.startswith("<!--", here):
            close = page.find("-->", here + 4)
            at = end if close < 0 else close + 3
        elif page.startswith(("<!", "<?"), here):
            close = page.find(">", here)
            at = end if close < 0 else close + 1
        else:
            found = pattern.match(page, here)
            if not found and pattern is TAG and PLAIN_TAG.match(page, here):
                pattern = PLAIN_TAG
                found = pattern.match(page, here)
            if not found:
                yield "text", "", "", "<"
                at = here + 1
                continue
            tag, at = found[2].lower(), found.end()
            if found[1]:
                yield "close", tag, "", ""
                continue
            yield "open", tag, found[3], ""
            if tag in RAW and not (tag in FOREIGN and found[3].endswith("/")):  # a slash closes no element of HTML
                close = re.compile(f"</{tag}(?![a-zA-Z0-9-])", re.I).search(page, at)
                at = end if not close else close.start()


def as_read(pieces: list[str]) -> str:
    return " ".join(html.unescape("".join(pieces)).split())


def blocks(page: str) -> list[Block]:
    """The page's non-empty blocks, in order, with the state in which they stood."""
    done: list[Block] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, out, region, link
    doubts: list[int] = []  # depths of open elements that raise doubt
    open_tags: Counter[str] = Counter()
    current = Block()
    links = headings = 0

    def flush() -> None:
        nonlocal current
        current.text = as_read(current.pieces)
        if current.text:
            current.link_chars = len(as_read(current.linked))
            done.append(current)
        out, region = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        current = Block(out=out, doubtful=bool(doubts), region=region, heading=headings > 0, paragraph=open_tags["p"] > 0)

    def unclosed(tag: str) -> bool:
        """Whether an element of the kind stands open with no list or table of its own inside it."""
        for name, *_ in reversed(stack[-OPEN_DEPTH:]):
            if name == tag:
                return True
            if name in CLOSED_BY[tag]:
                return False
        return False

    def pop(tag: str) -> bool:
        nonlocal links, headings
        changed = False
        while stack:
            name, out, _, link = stack.pop()
            if doubts and doubts[-1] == len(stack):
                doubts.pop()
            open_tags[name] -= 1
            links -= link
            headings -= name in HEADINGS
            changed = changed or out != (stack[-1][1] if stack else False)
            if name == tag:
                return changed
        return changed

    for kind, tag, rest, text in tokens(page):
        if kind == "text":
            current.pieces.append(text)
            if links:
                current.linked.append(text)
            continue
        if tag == "br":
            current.pieces.append(" ")
            current.linked.append(" ")
            continue
        block = tag not in INLINE
        if kind == "open":
            out, region = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            own, doubt = standing(tag, rest, region)
            if block or own != out and own:
                flush()
            if block and open_tags["p"] and tag != "p" and stack and stack[-1][0] == "p":
                pop("p")
            if tag == "p" and open_tags["p"] and any(s[0] == "p" for s in stack[-3:]) or tag in CLOSED_BY and open_tags[tag] and unclosed(tag):
                pop(tag)
            out, region = (stack[-1][1], stack[-1][2]) if stack else (False, False)
            if tag not in VOID and not rest.endswith("/"):
                link = tag == "a" and "href" in rest.lower()
                if doubt:
                    doubts.append(len(stack))
                stack.append((tag, out or own, region or tag in REGION, link))
                open_tags[tag] += 1
                links += link
                headings += tag in HEADINGS
            current.out, current.region, current.doubtful = (*stack[-1][1:3], bool(doubts)) if stack else (False, False, False)
            current.heading, current.paragraph = headings > 0, open_tags["p"] > 0
        else:
            if block:
                flush()
            if open_tags[tag]:
                if not block and stack and stack[-1][1]:
                    parent = stack[-2][1] if len(stack) > 1 else False
                    if not parent:
                        flush()
                pop(tag)
            current.out, current.region, current.doubtful = (*stack[-1][1:3], bool(doubts)) if stack else (False, False, False)
            current.heading, current.paragraph = headings > 0, open_tags["p"] > 0
    flush()
    return done


def words_of(text: str) -> list[str]:
    """Lower-case words without what stands around their letters; a number is an empty word, signs alone are none."""
    found = []
    for w in text.lower().split():
        bare = w if w.isalpha() else ENDS.sub("", w)
        if bare or any(c.isdigit() for c in w):
            found.append(bare)
    return found


def language_of(page: str) -> str:
    """The primary subtag of the language that the page declares, or an empty text."""
    tag = HTML_TAG.search(page)
    found = LANGUAGE.search(tag[1]) if tag else None
    return found[1].lower() if found else ""


def first_label(block: Block, stop_words: set[str]) -> str:
    """A block's label by itself: good, open (long, but with few stop words), unsure or bad."""
    length = len(block.text)
    if block.out:
        return "bad"
    if block.link_chars > MOST_LINKS * length:
        return "unsure" if block.heading or block.region and block.paragraph and not block.doubtful else "bad"
    if length < SHORT and block.doubtful:
        return "bad"
    if length < SHORT:
        return "bad" if block.link_chars and not block.region and not block.heading else "unsure"
    words = words_of(block.text)
    stops = sum(w in stop_words for w in words) / max(1, len(words))
    few_links = block.link_chars <= FEW_LINKS * length
    if block.doubtful:
        return "good" if few_links and (length > LONG and stops >= LOW_STOPS or block.region and stops >= HIGH_STOPS) else "bad"
    if block.region:
        return "good" if stops >= LOW_STOPS or few_links else "unsure"
    if stops >= HIGH_STOPS or (stops >= LOW_STOPS and length > LONG):
        return "good"
    return "unsure" if stops >= LOW_STOPS else "open" if few_links else "bad"


def inherit(found: list[Block]) -> None:
    """Second pass over the blocks of one kind: what is unsure becomes + or -."""
    decided = [i for i, b in enumerate(found) if b.label != "unsure"]
    before, at = None, 0
    for i, b in enumerate(found):
        if b.label != "unsure":
            before = i
            continue
        while at < len(decided) and decided[at] < i:
            at += 1
        after = decided[at] if at < len(decided) else None
        near = [j for j in (before, after) if j is not None]
        if not near:
            b.label = "+" if b.region or len(b.text) >= SHORT else "-"
        elif b.heading and after is not None:
            b.label = "+" if found[after].label == "good" else "-"
        else:
            least = min(abs(j - i) for j in near)
            b.label = "+" if any(found[j].label == "good" for j in near if abs(j - i) == least) else "-"


def label(found: list[Block], stop_words: set[str]) -> list[Block]:
    for b in found:
        b.label = first_label(b, stop_words)
    size = {k: sum(len(b.text) for b in found if b.label == k and not b.region) for k in ("good", "open")}
    for b in found:
        if b.label == "open":
            b.label = "good" if size["open"] > size["good"] else "unsure"
    for region in (False, True):
        inherit([b for b in found if not b.out and b.region == region])
    return [b for b in found if b.label in ("good", "+")]


def main_text(page: str | None, learnt: dict[str, set[str]] | None = None) -> str:
    """learnt: by language, its stop words; of other languages they are STOPS."""
    page = page or ""
    return "\n".join(b.text for b in label(blocks(page), (learnt or {}).get(language_of(page), STOPS)))


def short_words(pages: list[tuple[str, list[Block]]]) -> Iterator[tuple[str, str, int, int]]:
    """(language, word, times, pages) of the short words in long blocks that aren't links, from languages and blocks of pages;
    under the empty word the number of all their words."""
    counts: Counter[tuple[str, str]] = Counter()
    on_pages: Counter[tuple[str, str]] = Counter()
    for language, found in pages:
        own: Counter[str] = Counter()
        for b in found:
            if not b.out and len(b.text) >= SHORT and b.link_chars <= FEW_LINKS * len(b.text):
                words = words_of(b.text)
                own.update(w for w in words if 0 < len(w) <= SHORT_WORD)
                own[""] += len(words)
        for word, n in own.items():
            counts[language, word] += n
            on_pages[language, word] += 1
    return ((*key, n, on_pages[key]) for key, n in counts.items())


def as_told(block: Block) -> int:
    return block.link_chars << len(MARKS) | sum(getattr(block, m) << i for i, m in enumerate(MARKS))


def as_block(text: str, told: int) -> Block:
    return Block(text=text, link_chars=told >> len(MARKS), **{m: bool(told >> i & 1) for i, m in enumerate(MARKS)})


def parse(pages: DataFrame) -> DataFrame:
    """PARSED: a row for each of `pages`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column(2)):
                found = [(language_of(h or ""), [b for b in blocks(h or "") if not b.out]) for h in part]
                counts = list(zip(*short_words(found))) or [()] * 4
                first = lambda values, kind: pa.array([list(values), *[None] * (len(part) - 1)], pa.list_(kind))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).slice(at, len(part)) for i in (0, 1)], pa.array([x for x, _ in found], pa.string()),
                        pa.array(["\n".join(b.text for b in own) for _, own in found], pa.string()), pa.array([[as_told(b) for b in own] for _, own in found], pa.list_(pa.int64())),
                        *[first(x, kind) for x, kind in zip(counts, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                    ],
                    [c.split()[0] for c in PARSED.split(", ")],
                )

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return own.mapInArrow(run, PARSED)


def frequent_words(parsed: DataFrame) -> dict[str, set[str]]:
    """The stop words of each language that pages declare (none counts as one), from all parsed pages: at most
    1 / FREQUENT words a language, and languages are codes of two or three letters."""
    each = parsed.where("words IS NOT NULL").select(F.explode(F.arrays_zip("languages", "words", "n", "pages")).alias("x"))
    named = each.select(F.col("x.languages").alias("language"), F.col("x.words").alias("word"), "x.n", "x.pages")
    counts = stored(named.groupBy("language", "word").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages")), "page-words")
    totals = counts.where("word = ''").select("language", F.col("n").alias("total"))
    frequent = counts.join(F.broadcast(totals), "language").where(f"word != '' AND pages >= {LEAST_PAGES} AND n >= {FREQUENT} * total")
    found: dict[str, set[str]] = {}
    for r in frequent.select("language", "word").collect():
        found.setdefault(r["language"], set()).add(r["word"])
    return found


def learn(pages: DataFrame) -> dict[str, set[str]]:
    """The stop words of each language, from all of `pages`."""
    return frequent_words(parse(pages))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text for each row of `pages`.

    The text is empty if html is null, empty or has no article. A row's text depends on the
    others only by the stop words learnt from all of them; repeated rows count each there,
    null ids don't matter, an empty table gives an empty result, other columns are ignored.
    Very long pages are read whole, in time linear in their length.
    """
    parsed = stored(parse(pages), "page-blocks")
    learnt = {k: v | STOPS for k, v in frequent_words(parsed).items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for at, part in slices(batch.column(3)):
                languages, told = (batch.column(i).slice(at, len(part)).to_pylist() for i in (2, 4))
                for language, lines, own in zip(languages, part, told):
                    found = [as_block(*x) for x in zip(lines.split("\n"), own)]
                    texts.append("\n".join(b.text for b in label(found, learnt.get(language, STOPS))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return parsed.select("page_id", "url", "language", "text", "told").mapInArrow(run, "page_id long, url string, text string")


def op8_html_text(spark, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
