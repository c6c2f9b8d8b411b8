"""Main text of web pages by consensus of a host's pages.

Every page's containers are scored by the text of the blocks below them, without links. Each page gives its container
paths (tags with classes, digits generalised) their shares of its score as votes; Spark adds the votes per host. The
second pass takes each page's text from the container with the best path of its host.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialweave.llm.common import short_batches
from trialweave.llm.urls import with_host_and_path
from trialweave.session import stage

# Paths of a host a page may follow, best first.
PATHS_PER_HOST = 3


def page_parser():
    """Functions on one page: ``votes(html)`` and ``text(html, paths)``."""
    import re
    from html import unescape

    tag = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
    attribute = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
    digits, tokens = re.compile(r"\d+"), re.compile(r"[a-z]+")
    raw = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
    void = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
    holders = {"html", "body", "article", "main", "section", "div", "td", "th", "table", "tbody", "thead", "tfoot", "tr", "ul", "ol", "dl",
               "blockquote", "figure", "details", "center", "fieldset", "header", "hgroup", "address"}
    leaves = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "figcaption", "caption", "summary", "legend"}
    dropped = {"nav", "footer", "aside", "form", "script", "style", "noscript", "iframe", "template", "textarea", "title", "head", "svg",
               "button", "select", "dialog", "menu", "object", "canvas", "audio", "video"}
    candidates = {"body", "article", "main", "section", "div", "td"}
    # Words in class or id that mark what is not the article.
    hints = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist",
             "consent", "cookie", "cookies", "copyright", "disclaimer", "discussion", "disqus", "foot", "footer", "login", "menu", "modal", "nav", "navbar",
             "navigation", "newsletter", "notice", "notices", "notification", "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended",
             "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
             "toolbar", "widget", "widgets", "alert", "responses", "reactions"}
    roles = {"navigation", "banner", "complementary", "contentinfo", "search", "dialog", "alert", "form", "menu"}
    good = {"article", "content", "entry", "main", "post", "story", "text"}
    implied = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

    def read(html):
        """Containers as (parent, path, tag, weight) and blocks as (container, text, characters in links)."""
        containers, blocks = [(-1, "", "html", 1.0)], []
        stack = [("html", 0, False)]  # tag, container, dropped
        pieces, linked, in_link = [], 0, 0

        def flush():
            nonlocal linked
            if pieces:
                said = " ".join("".join(pieces).split())
                if said:
                    blocks.append((stack[-1][1], said, linked))
                pieces.clear()
                linked = 0

        at, end = 0, len(html)
        while at < end:
            found = tag.search(html, at)
            said = html[at:found.start()] if found else html[at:]
            if said and not stack[-1][2]:
                if "&" in said:
                    said = unescape(said)
                pieces.append(said)
                if in_link:
                    linked += len(said)
            if not found:
                break
            at = found.end()
            name = found[2]
            if not name:
                continue
            name = name.lower()
            is_block = name in holders or name in leaves or name in dropped
            if is_block:
                flush()
            if found[1]:
                if name == "a":
                    in_link = 0
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        del stack[i:]
                        break
                    if name not in holders and name not in dropped and (stack[i][0] in holders or stack[i][0] in dropped):
                        break
                continue
            if name in void:
                if name in ("br", "hr"):
                    pieces.append(" ")
                continue
            if name in raw:
                closing = raw[name].search(html, at)
                at = closing.end() if closing else end
                continue
            if name == "a":
                in_link = 1
            if not is_block:
                if not found[3].endswith("/"):
                    stack.append((name, stack[-1][1], stack[-1][2]))
                continue
            shut = implied.get(name, {"p"})
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in shut:
                    del stack[i:]
                    break
                if stack[i][0] in holders or stack[i][0] in dropped:
                    if name not in ("tr", "td", "th") or stack[i][0] in ("table", "tbody", "thead", "tfoot"):
                        break
            _, holder, gone = stack[-1]
            words, classes, role = set(), [], ""
            if not gone and found[3].strip():
                for a in attribute.finditer(found[3]):
                    kind, value = a[1].lower(), (a[2] or "").strip("\"'").lower()
                    if kind == "class":
                        classes = value.split()
                        words.update(tokens.findall(value))
                    elif kind == "id":
                        words.update(tokens.findall(value))
                    elif kind == "role":
                        role = value
                    elif kind == "hidden" or (kind == "aria-hidden" and value == "true") or (kind == "style" and "display:none" in value.replace(" ", "")):
                        gone = True
            inside = any(s[0] in ("article", "main") for s in stack)
            if name in dropped or role in roles or (words & hints and name != "body" and name != "article") or (
                    not inside and (name == "header" or "header" in words) and name != "body"):
                gone = True
            if name in holders:
                if not gone:
                    path = containers[holder][1] + "/" + ".".join([name, *sorted({digits.sub("#", c) for c in classes})])
                    weight = 1.5 if name in ("article", "main") or role in ("main", "article") else 1.25 if words & good else 1.0
                    containers.append((holder, path, name, weight))
                    holder = len(containers) - 1
            if not found[3].endswith("/"):
                stack.append((name, holder, gone))
        flush()
        return containers, blocks

    def scores(containers, blocks):
        out = [0.0] * len(containers)
        for holder, said, linked in blocks:
            value = max(0, len(said) - 2 * linked)
            share = 1.0
            while holder >= 0:
                if containers[holder][2] in candidates:
                    out[holder] += value * share
                    share *= 0.7
                holder = containers[holder][0]
        return [s * c[3] if c[2] in candidates else 0.0 for s, c in zip(out, containers)]

    def votes(html):
        containers, blocks = read(html)
        points = scores(containers, blocks)
        total = sum(points)
        out = {}
        for c, p in zip(containers, points):
            if p > 0:
                out[c[1]] = out.get(c[1], 0) + int(1000 * p / total)
        return out

    def text(html, paths):
        containers, blocks = read(html)
        known = {c[1] for c in containers}
        path = next((p for p in paths if p in known), None)
        if path is None:
            points = scores(containers, blocks)
            path = containers[max(range(len(points)), key=lambda i: (points[i], -i))][1]
        within = []
        for parent, own, *_ in containers:
            within.append(own == path or (parent >= 0 and within[parent]))
        return "\n\n".join(said for holder, said, _ in blocks if within[holder])

    return votes, text


def _votes(batches):
    import pandas as pd

    votes, _ = page_parser()
    for pdf in batches:
        out = {}
        for host, html in zip(pdf["host"], pdf["html"]):
            for path, n in votes(html).items():
                out[host, path] = out.get((host, path), 0) + n
        yield pd.DataFrame([(h, p, n) for (h, p), n in out.items()], columns=["host", "path", "votes"])


def _texts(batches):
    import pandas as pd

    _, text = page_parser()
    for pdf in batches:
        said = [text(html, [] if paths is None else list(paths)) if html else "" for html, paths in zip(pdf["html"], pdf["paths"])]
        yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": said, "n_chars": [len(s) for s in said]})


def host_paths(pages: DataFrame, paths: int = PATHS_PER_HOST) -> DataFrame:
    """Per host its best container paths, by votes and then by name. ``pages`` has host and html."""
    cast = pages.where(F.length("html") > 0).select("host", "html").mapInPandas(_votes, "host string, path string, votes long")
    counted = cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    best = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= paths)
    return best.groupBy("host").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"]).alias("paths"))


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", paths: int = PATHS_PER_HOST) -> DataFrame:
    """One row per page: key, url, the article's text and its length in code points.

    Null or empty html gives an empty text; pages with a null url vote and are read as one host. A page without any path of
    its host follows its own best container. Repeated rows stay and vote each; an empty table gives none; no other column is
    read. Votes are added per task before they are shuffled, so a hot host is a sum like any other.
    """
    short_batches(pages.sparkSession)
    slim = with_host_and_path(pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")), "url").drop("path")
    # Written first, so that Spark knows its size and leaves the pages where they are while it is small.
    best = stage(host_paths(slim, paths), "host-paths")
    joined = slim.join(best, "host", "left").select("page_id", "url", "html", "paths")
    kind = dict(slim.dtypes)["page_id"]
    return joined.mapInPandas(_texts, f"page_id {kind}, url string, text string, n_chars long")
