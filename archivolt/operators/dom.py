"""Main content of HTML pages and its Markdown, where a tree is needed.

No built-in function walks a tree, so pages go through `mapInPandas` and the standard parser; a page is a row, nothing is
shuffled. The content is the subtree with the most text outside links, a selector's subtree if one is given and found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

VOID = set("area base br col embed hr img input link meta source track wbr".split())
SKIP = set("script style noscript template nav footer aside form button svg".split())
BLOCK = set("p div section article main header ul ol li table tr blockquote pre h1 h2 h3 h4 h5 h6 figure dl dt dd".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() if c.tag not in SKIP else " " for c in self.children)


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        while len(self.stack) > 1 and self.stack[-1].tag in CLOSES.get(tag, ()):
            self.stack.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].children.append(node)
        if tag not in VOID and len(self.stack) < 200:
            self.stack.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def _walk(node: Node):
    stack = [node]
    while stack:
        n = stack.pop()
        yield n
        stack.extend(c for c in reversed(n.children) if isinstance(c, Node))


def _fits(node: Node, part: str) -> bool:
    m = re.fullmatch(r"([a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)(?:\[([\w-]+)(?:=[\"']?([^\"'\]]*)[\"']?)?\])?", part)
    if not m or (m[1] and node.tag != m[1].lower()):
        return False
    for mark, name in re.findall(r"([.#])([\w-]+)", m[2]):
        if name not in (node.attrs.get("class", "").split() if mark == "." else [node.attrs.get("id")]):
            return False
    return not m[3] or (m[3] in node.attrs and (m[4] is None or node.attrs[m[3]] == m[4]))


def select(root: Node, selector: str) -> list[Node]:
    """Tags, .class, #id, [attribute=value] and descendants."""
    found = [root]
    for part in selector.split():
        seen, nxt = set(), []
        for f in found:
            for n in _walk(f):
                if n is not f and id(n) not in seen and _fits(n, part):
                    seen.add(id(n))
                    nxt.append(n)
        found = nxt
    return found


def main_content(root: Node, selector: str | None = None, exclude: tuple[str, ...] = ()) -> tuple[Node, str]:
    """(subtree, how it was found: rules, density or whole)."""
    for sel in exclude:
        gone = {id(n) for n in select(root, sel)}
        for n in _walk(root):
            n.children = [c for c in n.children if isinstance(c, str) or id(c) not in gone]
    if selector and (hit := select(root, selector)):
        return hit[0], "rules"
    best, most = root, 0.0
    for n in _walk(root):
        if n.tag in ("article", "main", "section", "div", "td", "body"):
            inside = len(re.sub(r"\s+", " ", n.text()))
            linked = sum(len(re.sub(r"\s+", " ", x.text())) for x in _walk(n) if x.tag == "a")
            own = sum(len(x.text()) for x in n.children if isinstance(x, Node) and x.tag in ("p", "pre", "ul", "ol", "blockquote", "table", "h1", "h2", "h3"))
            score = (own + 0.2 * inside) * (1 - linked / max(inside, 1))
            if score > most:
                best, most = n, score
    return (best, "density") if most >= 25 else (root, "whole")


def _inline(node: Node) -> str:
    out = []
    for c in node.children:
        if isinstance(c, str):
            out.append(re.sub(r"\s+", " ", c))
        elif c.tag in SKIP:
            continue
        elif c.tag in ("strong", "b"):
            out.append(f"**{_inline(c).strip()}**" if _inline(c).strip() else "")
        elif c.tag in ("em", "i"):
            out.append(f"*{_inline(c).strip()}*" if _inline(c).strip() else "")
        elif c.tag == "code":
            out.append(f"`{c.text()}`")
        elif c.tag == "a" and c.attrs.get("href"):
            out.append(f"[{_inline(c).strip()}]({c.attrs['href']})")
        elif c.tag == "img" and c.attrs.get("src"):
            out.append(f"![{c.attrs.get('alt', '')}]({c.attrs['src']})")
        elif c.tag == "br":
            out.append("  \n")
        else:
            out.append(_inline(c))
    return "".join(out)


def _cells(row: Node) -> list[str]:
    return [_inline(c).strip().replace("|", "\\|") for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]


def markdown(node: Node, depth: int = 0) -> str:
    """GitHub-flavoured Markdown: headings, lists, tables, fenced code, quotes, inline links."""
    blocks, run = [], []

    def flush():
        text = "".join(run).strip()
        run.clear()
        if text:
            blocks.append(text)

    for c in node.children:
        if isinstance(c, str) or c.tag not in BLOCK and c.tag not in SKIP and not any(isinstance(x, Node) and x.tag in BLOCK for x in c.children):
            run.append(re.sub(r"\s+", " ", c) if isinstance(c, str) else _inline(_wrapped(c)))
            continue
        flush()
        if c.tag in SKIP:
            continue
        if re.fullmatch("h[1-6]", c.tag):
            blocks.append("#" * int(c.tag[1]) + " " + _inline(c).strip())
        elif c.tag == "pre":
            blocks.append("```\n" + c.text().strip("\n") + "\n```")
        elif c.tag == "blockquote":
            blocks.append("\n".join("> " + r for r in markdown(c, depth).split("\n")))
        elif c.tag in ("ul", "ol"):
            items = [x for x in c.children if isinstance(x, Node) and x.tag == "li"]
            rows = []
            for i, x in enumerate(items):
                mark = f"{i + 1}. " if c.tag == "ol" else "- "
                rows.append(mark + markdown(x, depth + 1).replace("\n\n", "\n").replace("\n", "\n" + " " * len(mark)))
            blocks.append("\n".join(rows))
        elif c.tag == "table":
            rows = [_cells(r) for r in _walk(c) if r.tag == "tr"]
            rows = [r for r in rows if r]
            if rows:
                width = max(map(len, rows))
                lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
                blocks.append("\n".join([lines[0], "|" + " --- |" * width, *lines[1:]]))
        else:
            blocks.append(markdown(c, depth))
    flush()
    return "\n\n".join(b for b in blocks if b.strip())


def _wrapped(node: Node) -> Node:
    outer = Node("#span", {})
    outer.children.append(node)
    return outer


def html_to_markdown(pages: DataFrame, key: str, html: str, selector: str | None = None, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(key, markdown, method, words) of each page; NULL pages give an empty text, broken markup is read as browsers do."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, h in zip(pdf[key], pdf[html]):
                node, how = main_content(parse(h or ""), selector, exclude)
                md = markdown(node)
                rows.append((k, md, how, len(md.split())))
            yield pd.DataFrame(rows, columns=[key, "markdown", "method", "words"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(convert, f"{key} {kind}, markdown string, method string, words int")
