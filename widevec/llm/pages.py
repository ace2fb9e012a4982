"""Main text of web pages by differencing against the page of the nearest URL.

Pages of one host are paired by URL path. The text lines of both are aligned by a longest
common subsequence, and lines that they share, being the site's and not the page's, are
deleted. Lines inside the page's only article or main element are the page's even if another
page has them too; marks such as nav, footer or class="ad" take out what differs from page to
page without being text.
"""

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from widevec.llm.common import table, written

# Fixed values of HTML: elements that are never text, that have no content, that end a block.
SILENT = frozenset("script style noscript template iframe object svg math canvas head title select textarea".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary"
    " table tbody td tfoot th thead tr ul".split()
)
# Elements that hold no main text, and those that hold nothing else.
ASIDE = frozenset("nav footer aside form menu dialog button".split())
MAIN = frozenset(("article", "main"))
CLOSED_BY = {name: frozenset(("p",)) for name in BLOCK - {"body", "html"}} | {
    "li": frozenset(("li", "p")),
    "dt": frozenset(("dt", "dd", "p")),
    "dd": frozenset(("dt", "dd", "p")),
    "tr": frozenset(("tr", "td", "th", "p")),
    "td": frozenset(("td", "th", "p")),
    "th": frozenset(("td", "th", "p")),
    "option": frozenset(("option",)),
}
# Words of class, id or role that mark what is not main text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu"
    " breadcrumb breadcrumbs header masthead footer sidebar aside related cookie cookies consent notice notices alert"
    " popup modal newsletter subscribe signup share sharing social comment comments disqus discussion replies reply"
    " login search widget toolbar pagination contentinfo complementary".split()
)

# A class of several parts counts by its last one, unless the first says that it is not there.
DENIED = frozenset("has no not with without hide hidden show toggle".split())

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
SPECIAL = re.compile(r"[>\"']")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[a-z]+")


def tags(page):
    """(start, end, closing, name, attributes) of each tag and, with name None, of each comment
    or declaration, from left to right. The caller sends where to go on.

    A single pass, whatever stands in the page: a tag ends at the first ``>`` outside quotes;
    once there is none up to the end of the page, quotes no longer count, and after the last
    ``>`` there are no tags.
    """
    last = page.rfind(">")
    last_quote = {quote: page.rfind(quote) for quote in "\"'"}
    quoting = True
    at = page.find("<")
    while 0 <= at:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            skip = yield at, len(page) if end < 0 else end + 3, False, None, ""
        elif at > last:
            # Only a comment could still begin here.
            at = page.find("<!--", at)
            continue
        elif page.startswith(("<!", "<?"), at):
            skip = yield at, page.find(">", at) + 1, False, None, ""
        else:
            match = NAME.match(page, at, last + 1)
            if match is None:
                at = page.find("<", at + 1)
                continue
            begin = found = match.end()
            end = -1
            while quoting:
                mark = SPECIAL.search(page, found)
                if mark is None:
                    quoting = False
                elif mark.group() == ">":
                    end = mark.start()
                    break
                elif mark.start() == last_quote[mark.group()]:
                    quoting = False
                else:
                    found = page.find(mark.group(), mark.end()) + 1
            if end < 0:
                end = page.find(">", begin)
            skip = yield at, end + 1, bool(match.group(1)), match.group(2).lower(), page[begin:end]
        at = page.find("<", skip)


def blocks(page):
    """(text, zone) of each text block in page order. zone: 0 inside something marked as no
    main text, 2 or more inside an article or main element, a number for each, 1 elsewhere.
    An article in an article is of the outer one, the first in a main element of that.

    A class, id or role that marks an element does not count if the element holds all of the
    page's articles and main elements and most of its text: that is the page, not an aside.
    Time is in proportion to the page.
    """
    found, wrappers = _parsed(page, ())
    return _parsed(page, wrappers)[0] if wrappers else found


def _parsed(page, ignored):
    found, text = [], []
    # Open elements: name, zone, number of the mark. Of block elements also their place.
    stack, open_blocks, open_names = [], [], Counter()
    zone = 1
    articles, unused, open_articles = 0, set(), 0
    # Of every marked element: text and main elements before it, and in it.
    marks, letters, mains = [], 0, 0
    at = 0

    def flush():
        nonlocal letters
        if text:
            line = " ".join(entities.unescape("".join(text)).split())
            if line:
                found.append((line, zone))
                letters += len(line)
            text.clear()

    def zone_of():
        return stack[-1][1] if stack else 1

    def pop():
        nonlocal open_articles
        name, own, mark = stack.pop()
        open_names[name] -= 1
        if name in BLOCK:
            open_blocks.pop()
        if name == "article" and own >= 2:
            open_articles -= 1
        if mark is not None:
            marks[mark] = (letters - marks[mark][0], mains - marks[mark][1])
        return name

    walk = tags(page)
    match = next(walk, None)
    while match is not None:
        start, end, closing, name, attributes = match
        if start > at and zone >= 0:
            text.append(page[at:start])
        at = end
        if name == "br":
            text.append(" ")
        elif name is not None and closing:
            if name not in VOID and open_names[name]:
                if name in BLOCK or name in SILENT:
                    flush()
                while pop() != name:
                    pass
                zone = zone_of()
        elif name is not None:
            if name in BLOCK or name in SILENT:
                flush()
            if name in RAW:
                # No tags inside: everything up to the end tag is not text.
                close = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else len(page)
            elif name not in VOID:
                # A new block ends an open one of these, and what is still open inside it.
                if name in CLOSED_BY and open_blocks and stack[open_blocks[-1]][0] in CLOSED_BY[name]:
                    for _ in range(len(stack) - open_blocks[-1]):
                        pop()
                zone = zone_of()
                if name in BLOCK or not attributes.rstrip().endswith("/"):
                    outer, mark = zone, None
                    own = _zone(name, outer)
                    if name in MAIN:
                        mains += 1
                    if attributes and name not in ("body", "html", "main", "article") and _marked(attributes):
                        mark = len(marks)
                        marks.append((letters, mains))
                        if own > 0 and mark not in ignored:
                            own = 0
                    if name in MAIN and own >= 2:
                        nested = outer >= 2 and (name == "main" or outer in unused or open_articles > 0)
                        if nested:
                            own = outer
                        else:
                            articles += 1
                            own = articles + 1
                        if name == "article":
                            unused.discard(own)
                            open_articles += 1
                        elif not nested:
                            unused.add(own)
                    if name in BLOCK:
                        open_blocks.append(len(stack))
                    stack.append((name, own, mark))
                    open_names[name] += 1
                    zone = own
        try:
            match = walk.send(at)
        except StopIteration:
            match = None
    if at < len(page) and zone >= 0:
        text.append(page[at:])
    flush()
    while stack:
        pop()
    return found, [k for k, (own, held) in enumerate(marks) if mains and held == mains and 2 * own > letters]


def _marked(attributes):
    """Whether a class, id or role says that an element is no main text."""
    for groups in NAMED.findall(attributes):
        for name in "".join(groups).lower().split():
            parts = PART.findall(name)
            if parts and parts[-1] in MARKS and parts[0] not in DENIED:
                return True
    return False


def _zone(name, outer):
    if outer < 0 or name in SILENT:
        return -1
    if outer == 0 or name in ASIDE or (name == "header" and outer < 2):
        return 0
    return 2 if name in MAIN else outer


def common_lines(a, b):
    """Which places of ``a`` lie in a longest common subsequence with ``b``.

    Whole numbers hold a row of the table of lengths as bits, so a step costs the length of
    ``b`` over the size of a machine word.
    """
    matched = np.zeros(len(a), bool)
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    matched[:head] = True
    matched[len(a) - tail :] = tail > 0
    shared = set(a[head : len(a) - tail]) & set(b[head : len(b) - tail])
    mine = [k for k in range(head, len(a) - tail) if a[k] in shared]
    theirs = [k for k in range(head, len(b) - tail) if b[k] in shared]
    for k in _lcs([a[k] for k in mine], [b[k] for k in theirs]):
        matched[mine[k]] = True
    return matched


# Bits of table rows that are kept to walk back; above, the work is halved first.
KEPT_BITS = 1 << 28


def _rows(a, b):
    """The bit rows of the table for a's prefixes: bit k is 0 where b's first k + 1 lines hold
    one common line more than its first k."""
    places = {}
    for k, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for line in a:
        held = row & places.get(line, 0)
        row = (row + held | row - held) & full
        yield row


def _lcs(a, b):
    """Places in a of one longest common subsequence."""
    if not a or not b:
        return []
    if len(a) * len(b) > KEPT_BITS and len(a) > 1:
        half = len(a) // 2
        ahead = _lengths(a[:half], b)
        behind = _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int(np.argmax(ahead + behind))
        return _lcs(a[:half], b[:cut]) + [half + k for k in _lcs(a[half:], b[cut:])]
    rows = [(1 << len(b)) - 1, *_rows(a, b)]
    found, j = [], len(b)
    for i in range(len(a), 0, -1):
        # Skip the lines of b that add nothing here.
        gained = ~rows[i] & ((1 << j) - 1)
        j = gained.bit_length()
        if not j:
            break
        if rows[i - 1] >> (j - 1) & 1:
            found.append(i - 1)
            j -= 1
    return found[::-1]


def _lengths(a, b):
    """Length of the longest common subsequence of a with each prefix of b, from none to all."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    bits = np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    return np.concatenate(([0], np.cumsum(np.unpackbits(bits, bitorder="little")[: len(b)] == 0)))


def main_text(found, shared):
    """The blocks of a page that are its main text. shared: which ones the nearest page has.

    That is what is neither marked nor shared. Shared lines stay where they lie in an article
    or main element that is the only one of the page.
    """
    articles = {zone for _, zone in found if zone >= 2}
    only = articles if len(articles) == 1 else ()
    kept = [line for (line, zone), both in zip(found, shared) if zone in only or zone and not both]
    return "\n\n".join(kept)


def line_hashes(found):
    return np.array([hash_line(line) for line, _ in found], np.int64)


def hash_line(line):
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def _parsed_lines(rows):
    """(page_id, tie, host, path, digest, lines): hashes of each page's lines in order, and
    one of them all."""

    def run(batches):
        for batch in batches:
            lines = [line_hashes(blocks(page)) for page in batch.column("html").to_pylist()]
            digests = [xxhash.xxh3_128_digest(own.tobytes()) for own in lines]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in ("page_id", "tie", "host", "path")],
                    pa.array(digests, pa.binary()),
                    pa.array(lines, pa.list_(pa.int64())),
                ],
                ["page_id", "tie", "host", "path", "digest", "lines"],
            )

    return rows.mapInArrow(run, "page_id long, tie long, host string, path string, digest binary, lines array<long>")


def _nearest(rows, *keys):
    """(keys, path, near): of each path, the lines of the last page of the path before it, or
    of the first page of the path after it if there is none before."""
    at = F.struct("page_id", "tie")
    ends = rows.groupBy(*keys, "path").agg(F.min_by("lines", at).alias("first"), F.max_by("lines", at).alias("last"))
    order = Window.partitionBy(*keys).orderBy("path")
    near = F.coalesce(F.lag("last").over(order), F.lead("first").over(order))
    return ends.select(*keys, "path", near.alias("near")).filter(F.col("near").isNotNull())


def shared_lines(rows):
    """(page_id, tie, places): of each page, the places of the lines that the page of the
    nearest URL has too. Works on line hashes alone, so no page text is shuffled.

    Pages of a host with equal lines are one, that of the least path, and share its answer.
    Nearest is next in order of path within the host, the one before, or after for the
    first; pages of one path, be they versions or copies under other queries, are never
    compared with each other, and a host of a single path has no lines to share. Tasks hold
    ranges of (host, path, page_id), so none orders a whole host; where a path has its
    neighbour in another range, the rows at the ranges' ends meet it, four at most of each
    host and range.
    """
    lines = written(_parsed_lines(rows), "lines")
    pages = lines.filter(F.size("lines") > 0).groupBy("host", "digest").agg(
        F.min(F.struct("path", "page_id", "tie")).alias("k"), F.first("lines").alias("lines")
    )
    pages = pages.select("host", "digest", "k.*", "lines")
    place = ["host", "path", "page_id", "tie"]
    ranged = pages.repartitionByRange(*place).sortWithinPartitions(*place).select(*place, "digest", "lines")
    ranged = written(_compared_in_order(ranged), "ranges")
    near = _nearest(ranged.filter("edge"), "host")
    first = ranged.filter("not edge and places is null").select("host", "part", "path", "digest", "lines")
    # One row for each host and part, so a path of many parts is no hot key.
    near = first.select("host", "part", "path").distinct().join(near, ["host", "path"]).select("host", "part", "near")
    paired = first.join(near, ["host", "part"]).select("host", "digest", "lines", "near")
    places = ranged.filter("not edge and places is not null").select("host", "digest", "places")
    places = places.unionByName(_compared(paired))
    named = lines.select("page_id", "tie", "host", "digest").distinct()
    return named.join(places, ["host", "digest"]).select("page_id", "tie", "places")


def _compared_in_order(pages):
    """Pages in order of (host, path, page_id, tie): ``places`` of those whose host has an
    earlier path in their partition, ``lines`` of the others.

    Rows with ``edge`` are besides these: for each host of a partition the first page of its
    first two paths there and the last page of its last two, by which pages without an
    earlier path find theirs in other partitions.
    """
    kinds = "edge boolean, part int, host string, path string, page_id long, tie long, digest binary, lines array<long>, places array<int>"
    names = [kind.split()[0] for kind in kinds.split(", ")]
    types = [pa.bool_(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def run(batches):
        part = TaskContext.get().partitionId()
        # The last page, and the last of the path before its own; in which path of its host that is.
        last = before = None
        paths = 0

        def edge(page):
            return (True, part, *page[:4], None, page[5], None)

        for batch in batches:
            rows = []
            for page in zip(*[batch.column(n).to_pylist() for n in ("host", "path", "page_id", "tie", "digest", "lines")]):
                if last is None or page[0] != last[0]:
                    rows += [edge(p) for p in (before, last) if p]
                    rows.append(edge(page))
                    before, paths = None, 1
                elif page[1] != last[1]:
                    before, paths = last, paths + 1
                    if paths == 2:
                        rows.append(edge(page))
                last = page
                if before:
                    rows.append((False, part, *page[:5], None, np.flatnonzero(common_lines(page[5], before[5]))))
                else:
                    rows.append((False, part, *page, None))
            if rows:
                yield _batch(rows)
        if last:
            yield _batch([edge(p) for p in (before, last) if p])

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return pages.mapInArrow(run, kinds)


def _compared(paired):
    """(host, digest, places) of pages (host, digest, lines, near)."""

    def run(batches):
        for batch in batches:
            both = zip(batch.column("lines").to_pylist(), batch.column("near").to_pylist())
            places = [np.flatnonzero(common_lines(a, b)) for a, b in both]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("digest"), pa.array(places, pa.list_(pa.int32()))],
                ["host", "digest", "places"],
            )

    return paired.mapInArrow(run, "host string, digest binary, places array<int>")


def extract_pages(pages):
    """(page_id, url, text) of every page (page_id, url, html).

    Null html is empty, pages without main text have empty text; a null url is of a host of
    its own. Rows that repeat a page are equal in all that counts and share one answer. The
    html is read twice and shuffled once, to meet the places of its shared lines.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("tie", F.xxhash64("url", "html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    places = shared_lines(rows.select("page_id", "tie", host.alias("host"), path.alias("path"), "html"))
    places = places.groupBy("page_id", "tie").agg(F.max("places").alias("places"))
    named = places.select(F.col("page_id").alias("p_id"), F.col("tie").alias("p_tie"), "places")
    joined = rows.join(named, F.col("page_id").eqNullSafe(F.col("p_id")) & (F.col("tie") == F.col("p_tie")), "left")

    def run(batches):
        for batch in batches:
            texts = []
            for page, own in zip(batch.column("html").to_pylist(), batch.column("places").to_pylist()):
                found = blocks(page)
                shared = np.zeros(len(found), bool)
                shared[own or []] = True
                texts.append(main_text(found, shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return joined.select("page_id", "url", "html", "places").mapInArrow(run, "page_id long, url string, text string")


def op9_page_text(spark, sf_dir):
    found = extract_pages(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
