"""A small tree of a page's elements, for what needs more than a pattern. Used within Arrow functions only."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

# Elements that have no content.
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))


class Element:
    """A tag with its attributes, its children (elements and texts) and its parent."""

    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Element]:
        """All elements below, in document order; no recursion, as pages can be nested deeply."""
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Element):
                    yield child
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def all(self, wanted: Callable[[Element], bool]) -> list[Element]:
        return [e for e in self.walk() if wanted(e)]

    def first(self, wanted: Callable[[Element], bool]) -> Element | None:
        return next((e for e in self.walk() if wanted(e)), None)

    def has_class(self, *names: str) -> bool:
        return any(c in names for c in self.attrs.get("class", "").split())

    def class_part(self, part: str) -> bool:
        return any(part in c for c in self.attrs.get("class", "").split())

    def texts(self) -> Iterator[str]:
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Element):
                    stack.append(iter(child.children))
                    break
                yield child
            else:
                stack.pop()

    def text(self, between: str = "", strip: bool = True) -> str:
        """The texts below, each stripped, blank ones left out; unstripped on demand."""
        return between.join(t.strip() if strip else t for t in self.texts() if t.strip() or not strip)


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        e = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.at))

    def handle_endtag(self, tag: str) -> None:
        e = self.at
        while e.parent is not None and e.tag != tag:
            e = e.parent
        if e.parent is not None:
            self.at = e.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def read(page: str | None) -> Element:
    """The tree of a page; what can't be read ends it."""
    reader = _Reader()
    try:
        reader.feed(page or "")
        reader.close()
    except (AssertionError, ValueError):  # markup that the parser refuses
        pass
    return reader.root


def tag(*names: str) -> Callable[[Element], bool]:
    return lambda e: e.tag in names
