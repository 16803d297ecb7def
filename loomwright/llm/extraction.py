"""Main text of web pages by equivalence classes of template tokens.

* A page is a sequence of tokens: tags of containers, and runs of text between the
  tags of blocks, both told apart by the path of containers around them.  A token's
  occurrence vector says how often it occurs on each page of its host.
* Tokens of a host with one vector are an equivalence class.  Vectors aren't
  kept: the exclusive or of a hash of (page, count) over all pages stands for one,
  so that a host with a third of all pages is a sum like any other.
* Classes with a pair of tags that half of the pages have are valid; they nest by
  their containers into the host's template.  Runs of text in them are the
  template's own; what is between their tokens are slots.
* Slots are chosen by what the host's pages have in them: a slot's mass is its
  words without links and without the template's own runs.  From the whole page,
  the container with most of the mass is entered until text stands in it directly;
  that is the article.  In it, containers for something else by their element or by
  their links are left out.  Names (class, id, role) break ties alone: they halve
  a container's mass, and the article itself may have any name.
* The slots that remain are a page's text.

Each task adds up its own pages' vectors and passes on all of them, under a hash
of the token, so nothing is left out before the sums are complete, and the result
doesn't depend on how pages are dealt.  Tokens that half of a host's pages have
are at most twice as many as a page has, so a template is bounded by a page.
Templates go to all tasks if they are under ``SMALL`` bytes together, and meet
their pages in a salted join if not.

Edge cases: a null or empty page has no text; pages without a host are one host;
hosts with few pages have no template runs; a page that has nothing in its host's
article is judged by itself; a page whose whole article is the template's own
keeps it; a page may end anywhere, within a tag too; repeated pages count each;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, materialize, table

LEAST_PAGES = 8
SUPPORT = 0.5
FLUSH = 60_000
SMALL = 16_000_000
SALTS = 64
#: The share of a container's mass that one in it must have to be entered, and what an article element counts.
MOST, ARTICLE = 0.6, 10.0
#: Containers nested deeper are read as part of the one around them, as browsers do.
DEEPEST = 256
#: Elements that open a container, those whose text isn't text, and those that end a block.
CONTAINERS = frozenset("html body main article section div nav aside header footer form ul ol table figure dialog".split())
RAW = frozenset("script style noscript template textarea title svg iframe select".split())
INLINE = frozenset("a abbr b bdi bdo cite code data dfn em font i kbd mark q s samp small span strike strong sub sup time tt u var wbr label".split())
NOT_MAIN = frozenset("nav aside footer form dialog head".split())
#: Containers that can be a whole article.
ENTERED = frozenset("html body main article section div".split())
#: Words in class, id or role that say what a container is for.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|complementary|consent|contentinfo|cookies?|"
    r"disqus|footer|gdpr|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|notification|pagination|popup|promo|"
    r"related|replies|reply|respond|search|share|sharing|sidebar|signup|skip|social|sponsor|sponsored|subscribe|teaser|toolbar|widget)(?:$|[\s_-])",
    re.I,
)
PIECE = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<[a-zA-Z/](?:"[^"]*"|'[^']*'|[^'">])*$|[^<]+|<""", re.S)
#: Any attribute, its value taken along, so that no name is found within another's value.
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Numbers of pages in ids and in classes.
DIGITS = {"#": re.compile(r"\d+"), ".": re.compile(r"\d{3,}"), "@": re.compile(r"\d{3,}"), "!": re.compile(r"\d{3,}")}
MARKS = {"class": ".", "id": "#", "role": "@", "hidden": "!"}


def host_of(url: str | None) -> str:
    """The host of an address, lower-cased; empty if there is none."""
    found = re.match(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


Path = tuple[str, ...]


class Page:
    """Tokens and blocks of a page.

    ``blocks``: (path, text, words in links) in page order; a path is the
    containers' labels from the outermost.  ``tags``: tokens of tags, "<" or ">"
    and the path of what they open or close; the page itself has the empty path.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[Path, str, int]] = []
        self.tags: list[str] = ["<"]
        stack: list[tuple[str, str]] = []
        path: Path = ()
        parts: list[str] = []
        in_link, linked, at = False, 0, 0

        for found in PIECE.finditer(source):
            if found.start() < at:
                continue
            name = found[2]
            if name is None:
                text = found[0]
                if text[0] != "<" or text == "<":
                    parts.append(text)
                    if in_link:
                        linked += len(text.split())
                continue
            name, closing = name.lower(), bool(found[1])
            if name in RAW:
                if not closing and not (name == "svg" and found[3].endswith("/")):
                    raw_end = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, found.end())
                    at = raw_end.end() if raw_end else len(source)
                continue
            if name not in INLINE and parts:
                if text := " ".join(html.unescape("".join(parts)).split()):
                    self.blocks.append((path, text, linked))
                parts, linked = [], 0
            if name == "a":
                in_link = not closing
            elif name in CONTAINERS:
                if not closing:
                    stack.append((name, label_of(name, found[3])))
                    if len(stack) <= DEEPEST:
                        path = (*path, stack[-1][1])
                        self.tags.append("<" + "\0".join(path))
                elif any(n == name for n, _ in stack):
                    while stack[-1][0] != name:
                        stack.pop()
                    if len(stack) <= DEEPEST:
                        self.tags.append(">" + "\0".join(path[: len(stack)]))
                    stack.pop()
                    path = path[: len(stack)]
        if text := " ".join(html.unescape("".join(parts)).split()):
            self.blocks.append((path, text, linked))
        self.tags.append(">")

    def slots(self, runs: frozenset[int] = frozenset()) -> dict[Path, list[int]]:
        """(words, words in links) directly in each container, without the template's runs."""
        found: dict[Path, list[int]] = {}
        for path, text, linked in self.blocks:
            row = found.setdefault(path, [0, 0])
            if not runs or run_key(path, text) not in runs:
                row[0] += len(text.split())
                row[1] += linked
        return found


def label_of(name: str, attributes: str) -> str:
    """A container's name with its class, id and role; numbers in them that tell pages apart are one."""
    label = name
    if attributes:
        for key, *values in ATTRIBUTE.findall(attributes):
            if mark := MARKS.get(key.lower()):
                value = next((v for v in values if v), "").replace("!", " ").replace("\0", " ")
                label += mark + DIGITS[mark].sub("0", value.strip().lower())
    return label


def run_key(path: Path, text: str) -> int:
    """A signed 64-bit hash of a run of text at its place."""
    value = xxhash.xxh3_64_intdigest("\0".join(path) + "\1" + text)
    return value - (1 << 64) if value >> 63 else value


def element(label: str) -> str:
    return re.split(r"[.#@!]", label, maxsplit=1)[0]


def in_article(path: Path) -> bool:
    return any(element(x) in ("article", "main") for x in path)


def for_else(path: Path) -> bool:
    """Whether the last container of the path isn't for the article by its element."""
    name = element(path[-1])
    return name in NOT_MAIN or "!" in path[-1] or (name == "header" and not in_article(path))


def named_else(label: str) -> bool:
    """Whether a container's names say that it is for something else."""
    name, *marks = re.split(r"[.#@!]", label)
    return name not in ("html", "body", "article", "main") and any(NAMED.search(m) for m in marks)


def choose(slots: dict[Path, list[int]], main: Path | None = None) -> tuple[Path, set[Path]]:
    """The article's container, unless ``main`` is given, and the containers in it that are left out.

    ``slots``: (words, words in links) directly in each container.
    """
    mass: dict[Path, float] = defaultdict(float)
    words: dict[Path, int] = defaultdict(int)
    linked: dict[Path, int] = defaultdict(int)
    within: dict[Path, set[Path]] = defaultdict(set)
    own: dict[Path, float] = {}
    for path, (n, of_links) in slots.items():
        weight = ARTICLE if in_article(path) else 1.0
        for k, label in enumerate(path):
            weight *= 0.0 if for_else(path[: k + 1]) else 0.5 if named_else(label) else 1.0
            within[path[:k]].add(path[: k + 1])
        own[path] = weight * max(0, n - of_links)
        for k in range(len(path) + 1):
            mass[path[:k]] += own[path]
            words[path[:k]] += n
            linked[path[:k]] += of_links
    if main is None:
        main = ()
        while not own.get(main) and within[main]:
            best = max(sorted(within[main]), key=lambda x: mass[x])
            if element(best[-1]) not in ENTERED or not mass[best] or mass[best] < MOST * mass[main]:
                break
            main = best
    left_out = set()
    for path in list(words):
        if len(path) > len(main) and path[: len(main)] == main:
            links = 2 * linked[path] > words[path] and not in_article(path)
            name = named_else(path[-1]) and 2 * mass[path] < mass[main]
            if for_else(path) or links or name:
                left_out.add(path)
    return main, left_out


TOKENS = "host string, key long, tag string, slot long, vector long, pages long, total long, words long, linked long"
_TYPES = (pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 6)


def occurrence_vectors(pages: DataFrame) -> DataFrame:
    """A row for each token that ``SUPPORT`` of its host's pages have, by the sums over all pages (page_id, url, html).

    ``tag``: the token, null for runs of text; ``slot``: a run's container, as the
    key of its opening tag; ``words``, ``linked``: of a run, and of what stands
    directly in the container that a tag opens.  The tag "<" is the host's own row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list] = {}

        def flush():
            columns = [[k[0] for k in seen], [k[1] for k in seen], *([row[i] for row in seen.values()] for i in range(7))]
            columns[4] = [x - (1 << 64) if x >> 63 else x for x in columns[4]]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=[x.split()[0] for x in TOKENS.split(", ")])

        for batch in batches:
            for page_id, url, source in zip(*(batch.column(i) for i in range(3)), strict=True):
                if not (source := source.as_py()):
                    continue
                page, url = Page(source), url.as_py()
                host, keys = host_of(url), {}
                counts: dict[int, list] = {}
                for tag in page.tags:
                    key = keys.get(tag)
                    if key is None:
                        key = keys[tag] = run_key((), tag)
                        counts[key] = [tag, None, 0, 0, 0]
                    counts[key][2] += 1
                for path, text, linked in page.blocks:
                    slot = keys["<" + "\0".join(path)]
                    n, key = len(text.split()), run_key(path, text)
                    row = counts.setdefault(key, [None, slot, 0, 0, 0])
                    for x, k in ((row, 1), (counts[slot], 0)):
                        x[2] += k
                        x[3] += n
                        x[4] += linked
                mark = f"{page_id}|{url}|"
                marks: dict[int, int] = {}
                for key, (tag, slot, n, words, linked) in counts.items():
                    if n not in marks:
                        marks[n] = xxhash.xxh3_64_intdigest(f"{mark}{n}")
                    if (row := seen.get((host, key))) is None:
                        seen[host, key] = [tag, slot, marks[n], 1, n, words, linked]
                    else:
                        row[2] ^= marks[n]
                        row[3] += 1
                        row[4] += n
                        row[5] += words
                        row[6] += linked
                if len(seen) > FLUSH:
                    yield flush()
        yield flush()

    rows = pages.select("page_id", "url", "html").mapInArrow(lean(run), TOKENS)
    sums = rows.groupBy("host", "key").agg(
        F.max("tag").alias("tag"), F.max("slot").alias("slot"), F.bit_xor("vector").alias("vector"),
        *[F.sum(c).alias(c) for c in ("pages", "total", "words", "linked")],
    )
    # A host's row is read by all of its tokens', so both are read from a written table.
    found, _ = materialize(sums.filter("pages > 1 or tag is not null"), "vectors")
    hosts = found.filter("tag = '<'").select("host", F.col("pages").alias("all_pages"))
    kept = found.join(hosts, "host").filter(F.col("pages") >= SUPPORT * F.col("all_pages"))
    return kept.filter((F.col("all_pages") >= LEAST_PAGES) | F.col("tag").isNotNull()).drop("all_pages")


def deduce(rows: list[tuple]) -> dict:
    """A host's template from (key, tag, slot, vector, pages, total, words, linked) of its tokens.

    ``classes``: valid equivalence classes, the outermost first, with the index of
    the class they nest in; ``runs``: the template's own text, as keys; ``known``:
    all of its containers; ``main``: the article's; ``left_out``: those in it that
    are for something else.
    """
    pages = next((k for _, tag, _, _, k, *_ in rows if tag == "<"), 0)
    groups: dict[tuple[int, int, int], list[tuple]] = defaultdict(list)
    for row in rows:
        if row[4] >= SUPPORT * pages:
            groups[row[3], row[4], row[5]].append(row)
    classes, runs, slots, path_of = [], [], {}, {}
    for (_, k, total), tokens in groups.items():
        tags = sorted(t[1] for t in tokens if t[1] is not None)
        closed = {t[1:] for t in tags if t[0] == ">"}
        if not any(t[0] == "<" and t[1:] in closed for t in tags):
            continue  # no pair of tags holds the class together
        said = [t for t in tokens if t[1] is None] if pages >= LEAST_PAGES else []
        classes.append({"tags": tags, "runs": len(said), "pages": k, "per_page": total / k})
        runs += said
        for key, tag, _, _, _, _, words, linked in tokens:
            if tag is not None and tag[0] == "<":
                path_of[key] = tuple(tag[1:].split("\0")) if len(tag) > 1 else ()
                slots[path_of[key]] = [words, linked]
    for _, _, slot, _, _, _, words, linked in runs:
        if slot in path_of:
            slots[path_of[slot]][0] -= words
            slots[path_of[slot]][1] -= linked
    depth = lambda c: min((t.count("\0") + (len(t) > 1) for t in c["tags"]), default=0)
    classes.sort(key=lambda c: (depth(c), c["tags"]))
    holder = {t[1:]: i for i, c in enumerate(classes) for t in c["tags"] if t[0] == "<"}
    for i, c in enumerate(classes):
        around = min((t[1:] for t in c["tags"]), key=lambda t: (t.count("\0") + bool(t), t))
        while around and holder.get(around, i) == i:
            around = around.rpartition("\0")[0]
        c["parent"] = holder.get(around, -1) if holder.get(around) != i else -1
    main, left_out = choose(slots)
    return {
        "pages": pages, "classes": classes, "runs": sorted(r[0] for r in runs), "known": sorted(slots),
        "main": main, "left_out": sorted(left_out),
    }


def templates(pages: DataFrame) -> DataFrame:
    """(host, template as JSON) for each host."""
    vectors = occurrence_vectors(pages)
    columns = ("key", "tag", "slot", "vector", "pages", "total", "words", "linked")
    # Bounded: tokens that half of the pages have are at most twice as many as a page has.
    lists = vectors.groupBy("host").agg(F.collect_list(F.struct(*columns)).alias("rows"))

    @F.pandas_udf("string")
    def built(lists: pd.Series) -> pd.Series:
        return pd.Series([json.dumps(deduce([tuple(r[c] for c in columns) for r in rows])) for rows in lists], dtype=object)

    return lists.select("host", built("rows").alias("template"))


class Template:
    """What ``deduce`` found, ready to be applied."""

    def __init__(self, found: dict):
        self.pages = found.get("pages", 0)
        self.runs = frozenset(found.get("runs", ()))
        self.known = {tuple(x) for x in found.get("known", ())}
        self.main = tuple(found["main"]) if "main" in found else None
        self.left_out = {tuple(x) for x in found.get("left_out", ())}


def remaining_text(source: str | None, template: Template | None) -> str:
    """The text of a page's slots that are its article."""
    if not source:
        return ""
    page, template = Page(source), template or Template({})
    main = template.main
    inside = lambda path: main is None or path[: len(main)] == main
    if not any(inside(path) for path, *_ in page.blocks):
        main = None
    main, left_out = choose(page.slots(template.runs), main)
    # What the host knows of a container counts, not this one page.
    left_out = {x for x in left_out if x not in template.known} | template.left_out
    kept = [
        (path, text) for path, text, _ in page.blocks
        if inside(path) and not any(path[:k] in left_out for k in range(len(main) + 1, len(path) + 1))
    ]
    if template.runs:
        kept = [(path, text) for path, text in kept if run_key(path, text) not in template.runs] or kept
    return "\n".join(text for _, text in kept)


RESULT = "page_id long, url string, text string, n_chars long, template_pages long"


def extracted(pages: DataFrame) -> DataFrame:
    """Main text of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    made, _ = materialize(templates(pages), "templates")
    size = made.agg(F.sum(F.length("template") + F.length("host")).alias("n")).first()["n"] or 0
    shared = None
    if size <= SMALL:
        shared = spark.sparkContext.broadcast({r["host"]: r["template"] for r in made.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[str, Template] = {}
        for batch in batches:
            texts, sizes = [], []
            for i in range(len(batch)):
                host = host_of(batch.column(1)[i].as_py())
                if host not in parsed:
                    if len(parsed) > 200:
                        parsed.clear()
                    raw = shared.value.get(host) if shared is not None else batch.column(3)[i].as_py()
                    parsed[host] = Template(json.loads(raw) if raw else {})
                texts.append(remaining_text(batch.column(2)[i].as_py(), parsed[host]))
                sizes.append(parsed[host].pages)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(sizes, pa.int64())],
                names=[x.split()[0] for x in RESULT.split(", ")],
            )

    rows = pages.select("page_id", "url", "html")
    if shared is None:

        @F.pandas_udf("string")
        def host(urls: pd.Series) -> pd.Series:
            return pd.Series([host_of(u) for u in urls], dtype=object)

        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))
        keyed = rows.withColumns({"host": host("url"), "salt": salt})
        copies = made.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = keyed.join(copies, ["host", "salt"], "left").select("page_id", "url", "html", "template")
    return rows.mapInArrow(lean(run), RESULT)


def op1_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extracted(table(spark, sf_dir, "pages"))
