"""What elements hold, at any depth: a stack of open elements goes over the tags and texts of a piece of markup.

Flat patterns can't say where an element ends that holds others of its kind. This is the one step of page
extraction that runs in Python, on batches of sections that Spark has cut out of the pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

_TOKEN = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|([^<]+|<)")

# Elements without content, and the elements that an opening tag ends, as the HTML standard has them.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENDS = {
    "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "li": {"li"}, "option": {"option"},
    **{tag: {"p"} for tag in "p div table ul ol h1 h2 h3 h4 h5 h6 form hr section article header footer".split()},
}


class Tree:
    """Elements in order of their opening tags, each with its parent, and texts with the element they stand in.

    Element 0 is what holds the markup. A closing tag that nothing open fits ends it, if it is a ``div``, and is
    passed over otherwise.
    """

    def __init__(self, markup: str) -> None:
        self.tags, self.attributes, self.parents = [""], [""], [-1]
        self.texts: list[tuple[int, str]] = []
        stack = [0]
        for closing, name, attributes, text in _TOKEN.findall(markup):
            if text:
                self.texts.append((stack[-1], text))
                continue
            tag = name.lower()
            if not tag:
                continue
            if closing:
                at = next((i for i in range(len(stack) - 1, 0, -1) if self.tags[stack[i]] == tag), 0)
                if at:
                    del stack[at:]
                elif tag == "div":
                    break
                continue
            while len(stack) > 1 and self.tags[stack[-1]] in ENDS.get(tag, ()):
                stack.pop()
            self.tags.append(tag)
            self.attributes.append(attributes)
            self.parents.append(stack[-1])
            if tag not in VOID and not attributes.endswith("/"):
                stack.append(len(self.tags) - 1)

    def all(self, tag: str) -> Iterator[int]:
        return (i for i, t in enumerate(self.tags) if t == tag)

    def inside(self, element: int, outer: int) -> bool:
        while element > outer:
            element = self.parents[element]
        return element == outer

    def direct_texts(self, tag: str, outer: int) -> list[str]:
        """Texts that stand directly in an element of the tag, anywhere inside ``outer``."""
        return [text for at, text in self.texts if self.tags[at] == tag and at != outer and self.inside(at, outer)]

    def rows(self, outer: int) -> list[list[str]]:
        """Texts in the cells of each table row that has a cell, anywhere inside ``outer``."""
        with_cell = {self.parents[i] for i in self.all("td")}
        return [self.direct_texts("td", i) for i in self.all("tr") if i in with_cell and i != outer and self.inside(i, outer)]

    def tables_after(self, label: str) -> list[int]:
        """Tables with a sibling ``div`` before them that holds the label as a text, at any depth."""
        labelled: dict[int, int] = {}
        for at, text in self.texts:
            if unescape(text) == label:
                while at > 0:
                    if self.tags[at] == "div":
                        labelled[self.parents[at]] = min(at, labelled.get(self.parents[at], at))
                    at = self.parents[at]
        return [i for i in self.all("table") if labelled.get(self.parents[i], i) < i]


def law_texts(markup: str) -> list[str]:
    """Texts directly in a ``div`` that a paragraph follows inside the same parent and that isn't in italics."""
    tree = Tree(markup)
    last_paragraph: dict[int, int] = {}
    for i in tree.all("p"):
        last_paragraph[tree.parents[i]] = i
    chosen = {
        i for i in tree.all("div") if last_paragraph.get(tree.parents[i], 0) > i and "font-style:italic" not in tree.attributes[i]
    }
    return [text for at, text in tree.texts if at in chosen]


def signer_rows(markup: str) -> list[list[str]]:
    return Tree(markup).rows(0)


def course_parts(markup: str, deputies: str, senate: str, course: str) -> tuple[list[str], list[str], list[list[str]]]:
    """Cell texts of the first table after each chamber's label, and the rows of all tables after the course's."""
    tree = Tree(markup)
    first = [tree.direct_texts("td", tables[0]) if (tables := tree.tables_after(label)) else [] for label in (deputies, senate)]
    tables = tree.tables_after(course)
    with_cell = {tree.parents[i] for i in tree.all("td")}
    rows = [i for i in tree.all("tr") if i in with_cell and any(tree.inside(i, table) for table in tables)]
    return first[0], first[1], [tree.direct_texts("td", i) for i in rows]
