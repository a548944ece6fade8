"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree whose nodes are element paths (tag, class and id of each container from the
body down).  Per node and host, over all its pages:

* presentation: the entropy of the children that the node shows on a page;
* content: the entropy of the texts found directly in it on a page;

both divided by the entropy that all-different pages would have; pages with equal text count once.  A node's importance is
the mean of its presentation (a tenth) and of the contents in its branch, weighted by characters.  It is multiplied by a
prior: 0.2 for elements and class names of menus, headers, footers, sidebars, notices, adverts, forms and reader comments
(so these are always cut: footers and adverts that differ from page to page have the entropy of text), 0.5 outside the
article (else main) element of a page that has one, else 1.  Inside articles and main elements only names that say
nothing else (``notice``, ``ad-box``, ``site-footer``) have the prior 0.2; compounds such as ``legal-note`` or ``search-results``
have 0.5 there, so what differs from page to page stays.  Branches below the threshold are cut from each page of the
host, within articles as well; what is left is the page's text.  A paragraph that repeats among others under the same
element path stays.

Statistics travel as hashes, shuffled by (host, node, content, page), so a large
host is spread over tasks; the unimportant branches are a short list per host.  Blocks are the texts between the bounds of block
elements; ``<br>`` is white space.  Character references are decoded, white space becomes one space, blocks are joined by
a newline.

Defined cases: null html counts as empty and gives an empty text; a null URL or one without host belongs to the host "";
a host with few different pages relies on the prior; a page of which nothing
would be left keeps what is no noise by name; unclosed elements, comments, quotes and truncated pages are read as far as they
go; repeated rows come out each.  Columns other than id, URL and html are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Mapping

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.shared import Scratch, ship
from podium.llm.url_filter import split_url

THRESHOLD = 0.25
# priors of noise by name, of nodes outside the article (else main) of a page that has one, and of compound names inside
NOISE, OUTSIDE, HINTED = 0.2, 0.5, 0.5
LEAST_PAGES = 8  # different pages below which entropy says nothing about a node

RAW = frozenset("script style noscript template iframe textarea title svg math object canvas select".split())
#: Of these, the ones that hold markup: they may be closed in themselves (the first two), nest, or lack an end.
FOREIGN = frozenset("svg math".split())
HOLDING = FOREIGN | frozenset("template object canvas select".split())
VOID = frozenset("br img hr input meta link wbr area base col embed source track param".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
#: Elements whose end is implied by the start of these.
CLOSED_BY = {"p": BLOCK - {"td", "th", "caption"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
NOISE_TAGS = frozenset("nav footer aside form dialog menu button".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu".split())
_NAMES = """ad|ads|adv|advert[^\\W_]*|adsense|banner[^\\W_]*|sponsor[^\\W_]*|promo[^\\W_]*|nav[^\\W_]*|menu[^\\W_]*|breadcrumb[^\\W_]*|sidebar[^\\W_]*|foot|
footer[^\\W_]*|masthead[^\\W_]*|site-header|page-header|topbar|toolbar|cookie[^\\W_]*|consent[^\\W_]*|gdpr|notice[^\\W_]*|popup[^\\W_]*|modal[^\\W_]*|
newsletter[^\\W_]*|subscri[^\\W_]*|shar(?:e|ing)[^\\W_]*|social[^\\W_]*|comment[^\\W_]*|respond|replies|disqus[^\\W_]*|related[^\\W_]*|recommend[^\\W_]*|
widget[^\\W_]*|pagination|pager|login|signup|search[^\\W_]*|copyright|legal|skip-link""".replace("\n", "")
#: A noise name as a part of a class or id, and as all of it, layout words aside.
NOISE_NAMES = re.compile(rf"(?:^|[\s_-])(?:{_NAMES})(?:$|[\s_-])", re.I)
_LAYOUT = "(?:site|page|main|top|bottom|left|right|global|post|entry|inner|box|bar|banner|container|wrapper|wrap|section|area|block|unit|slot|links)"
NOISE_TOKENS = re.compile(rf"(?:^|\s)(?:{_LAYOUT}[_-]+)*(?:{_NAMES})(?:[_-]+(?:{_LAYOUT}|\d+))*(?:$|\s)", re.I)

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")


class Node:
    __slots__ = ("tag", "parent", "noise", "hinted", "article", "main", "children", "key")

    def __init__(self, tag: str, name: str, parent: "Node | None", noise: bool, hinted: bool = False):
        self.tag, self.parent, self.hinted = tag, parent, hinted
        # the path of names, digested step by step: its text would grow with the depth
        self.key = xxhash.xxh64_intdigest(name, parent.key + (1 << 63) if parent else 0) - (1 << 63)
        self.article = tag == "article" or bool(parent and parent.article)
        self.main = tag == "main" or bool(parent and parent.main)
        self.noise = noise or bool(parent and parent.noise)
        self.children: list[str] = []


def _is_noise(tag: str, attributes: dict[str, str], parent: Node | None) -> tuple[bool, bool]:
    """(noise by tag, role or name, a compound name that only hints at it)"""
    names = [attributes.get(k, "") for k in ("class", "id")]
    if tag in ("article", "main", "body", "html"):
        return tag == "article" and bool(NOISE_TOKENS.search(names[0])), False
    inside = bool(parent and (parent.article or parent.main))
    if tag in NOISE_TAGS or (tag == "header" and not inside) or attributes.get("role", "").lower() in NOISE_ROLES:
        return True, False
    named = any(NOISE_NAMES.search(x) for x in names)
    alone = any(NOISE_TOKENS.search(x) for x in names)
    return alone or (named and not inside), named and inside and not alone


def _raw_end(tag: str, attributes: str, page: str, at: int) -> int:
    """Where a page goes on behind the start of an element whose content is no text."""
    if tag not in HOLDING:  # scripts, styles and the like reach to their end or the page's
        return re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, at).end()
    if tag in FOREIGN and attributes.rstrip().endswith("/"):
        return at
    depth = 1
    for m in re.compile(rf"<(/?){tag}(?=[\s/>])([^>]*)>", re.I).finditer(page, at):
        if m[1]:
            depth -= 1
        elif not (tag in FOREIGN and m[2].endswith("/")):
            depth += 1
        if not depth:
            return m.end()
    return at  # never closed: only the tag is passed over


def parse(page: str) -> tuple[list[tuple[Node, str]], list[Node]]:
    """(blocks with their node, all nodes) in page order."""
    root = Node("html", "html", None, False)
    node, nodes, blocks, text = root, [root], [], []
    at = 0

    def flush() -> None:
        if text:
            block = " ".join("".join(text).split())
            if block:
                blocks.append((node, block))
            text.clear()

    while True:
        m = _TOKEN.search(page, at)
        piece = page[at:m.start()] if m else page[at:]
        if piece:
            text.append(html.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end
            if tag in BLOCK:
                flush()
                found = node
                while found.parent and found.tag != tag:
                    found = found.parent
                if found.tag == tag and found.parent:
                    node = found.parent
            continue
        if tag in RAW:
            at = _raw_end(tag, m[3] or m[6] or "", page, at)
            text.append(" ")
            continue
        if tag == "br" or tag == "img":
            text.append(" ")
            continue
        if tag not in BLOCK:
            continue
        flush()
        if tag in VOID or tag == "html":
            continue
        while node.parent and tag in CLOSED_BY.get(node.tag, ()):
            node = node.parent
        attributes = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTRIBUTE.findall(m[3] or m[6] or "")}
        name = ".".join([tag, *(_DIGITS.sub("0", attributes[k]) for k in ("class", "id") if attributes.get(k))])
        node.children.append(name)
        node = Node(tag, name, node, *_is_noise(tag, attributes, node))
        nodes.append(node)
    flush()
    return blocks, nodes


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


#: kind 0: contents, 1: presentation.  ``above`` lists the node and its ancestors, ``page`` digests the page's open text.
STATISTICS = "host string, node long, kind int, what long, page long, chars long, above array<long>"


def _statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        seen: dict[tuple, int] = {}
        above: dict[int, list[int]] = {}
        for url, page in zip(rows["url"], rows["html"]):
            host = split_url(url)[0]
            blocks, nodes = parse(page)
            version = _digest("\n".join(t for n, t in blocks if not n.noise))
            shown: dict[int, list[str]] = {}
            held: dict[int, list[str]] = {}
            for node in nodes:
                if node.tag in ("html", "body"):
                    continue  # there is nothing around it
                if node.key not in above:
                    chain, up = [], node
                    while up:
                        chain.append(up.key)
                        up = up.parent
                    above[node.key] = chain
                shown.setdefault(node.key, []).append(" ".join(node.children))
            for node, block in blocks:
                if node.key in shown:
                    held.setdefault(node.key, []).append(block)
            for kind, found in ((0, held), (1, shown)):
                for key, what in found.items():
                    seen[host, key, kind, _digest("\n".join(what)), version] = sum(map(len, what))
        yield pd.DataFrame([(*k, chars, above[k[1]]) for k, chars in seen.items()],
                           columns=["host", "node", "kind", "what", "page", "chars", "above"])


def importance(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, node, seen, importance) of all nodes: ``seen`` counts the pages whose open texts differ."""
    rows = (pages.select(F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
            .mapInPandas(_statistics, STATISTICS))
    each = (rows.dropDuplicates(["host", "node", "kind", "what", "page"]).groupBy("host", "node", "kind", "what")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.first("above").alias("above")))
    total = F.sum("n")
    entropy = F.when(total > 1, (F.log(total) - F.sum(F.col("n") * F.log("n")) / total) / F.log(total)).otherwise(1.0)
    nodes = each.groupBy("host", "node", "kind").agg(total.alias("seen"), F.sum("chars").alias("chars"), entropy.alias("entropy"), F.first("above").alias("above"))
    own = nodes.where("kind = 1").select("host", "node", "seen", F.col("entropy").alias("presentation"))
    # contents count for the node they stand in and for all above it
    content = (nodes.where("kind = 0").select("host", F.explode("above").alias("node"), "entropy", "chars")
               .groupBy("host", "node").agg((F.sum(F.col("entropy") * F.col("chars")) / F.sum("chars")).alias("content")))
    return (own.join(content, ["host", "node"], "left")
            .select("host", "node", "seen", F.when(F.col("content").isNull(), F.lit(1.0))
                    .otherwise(0.1 * F.col("presentation") + 0.9 * F.col("content")).alias("importance")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per row ``page_id, url, text, n_chars``; also ``n_cut``, the blocks cut with low-importance branches."""
    spark = pages.sparkSession
    ship(spark)
    tmp = Scratch(spark, "style-tree")
    # whatever is more important than that stays under any prior but that of noise
    cut = tmp.write(importance(pages, url_col, html_col).where((F.col("importance") * OUTSIDE < threshold) & (F.col("seen") >= least_pages))
                    .groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("node", "importance"))).alias("cut")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for i, url, page, low in zip(rows["id"], rows["url"], rows["html"], rows["cut"]):
                out.append((i, url, *main_text(page, dict(low) if low is not None else {}, threshold)))
            yield pd.DataFrame(out, columns=["id", "url", "text", "n_chars", "n_cut"]).astype({"id": rows["id"].dtype})

    kind = pages.schema[id_col].dataType.simpleString()
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.expr("substr(coalesce(url, ''), instr(coalesce(url, ''), '://') + 3)"), "/", 1)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("host", host).join(cut, "host", "left")
    return (rows.select("id", "url", "html", "cut").mapInPandas(run, f"id {kind}, url string, text string, n_chars long, n_cut long")
            .withColumnRenamed("id", id_col))


def main_text(page: str, found: Mapping[int, float] | frozenset = frozenset(), threshold: float = THRESHOLD) -> tuple[str, int, int]:
    """(text, code points, blocks cut for their branch's low importance other than by the prior of noise).  ``found`` holds
    importances on the host; a node without one counts as fully important."""
    blocks, _ = parse(page)
    importance = dict(found) if found else {}
    centre = next((c for c in ("article", "main") if any(getattr(n, c) and not n.noise for n, _ in blocks)), None)
    cut: dict[int, bool] = {}

    def is_cut(node: Node) -> bool:
        up = node
        while up:
            prior = min(1.0 if centre is None or getattr(node, centre) else OUTSIDE, HINTED if up.hinted else 1.0)
            if prior * importance.get(up.key, 1.0) < threshold:
                return True
            up = up.parent
        return False

    open_blocks = [(n, t) for n, t in blocks if NOISE * importance.get(n.key, 1.0) >= threshold or not n.noise]
    for node, _ in open_blocks:
        if id(node) not in cut:
            cut[id(node)] = is_cut(node)
    kept = [t for n, t in open_blocks if not cut[id(n)]]
    n_cut = len(open_blocks) - len(kept)
    if not kept:  # nothing is left to tell from boilerplate
        kept, n_cut = [t for _, t in open_blocks], 0
    text = "\n".join(kept)
    return text, len(text), n_cut
