"""Leaf blocks of a page: runs of text between block tags, with their paths, in one pass."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_TAG = re.compile(r"""</?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|data-y)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfenced mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt "
    "mstyle msub msubsup msup mtext munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text of the page.
RAW = frozenset("script style noscript template svg iframe object canvas title textarea select annotation".split())
#: Opening one of these ends an open one of those.
_ENDS = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
_SCOPE = {"li": {"ul", "ol"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dd": {"dl"}, "dt": {"dl"}}


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  #: tags and words of classes, ids and roles, outermost first
    linked: float  #: share of characters inside links
    mark: int | None = None  #: the nearest ``data-y`` (made-up pages only)


class _Open:
    __slots__ = ("mark", "name", "words")

    def __init__(self, name: str, words: tuple[str, ...], mark: int | None):
        self.name, self.words, self.mark = name, words, mark


#: Innermost elements whose words are all in a path; those further out give each word once.
_NEAR = 14


def read_blocks(page: str | None, marked: bool = False) -> list[Block]:
    """Blocks with text, in page order; scripts, styles, comments and markup are none.

    With ``marked`` a ``data-y`` attribute is a training label; in other pages it is like any.
    Character references are decoded, white space becomes one blank.  Stray end tags are
    passed over; unclosed tags end with what holds them.  A tag with an unbalanced quote, and all
    behind it, end at their first ``>``.  The time grows with the page's length.
    """
    page = page or ""
    lowered = page.lower() if len(page.lower()) == len(page) else page
    out: list[Block] = []
    stack: list[_Open] = []
    places: dict[str, list[int]] = {}  # where in the stack the elements of a name are
    far: dict[str, int] = {}  # words of the elements further out, and how often
    unclosed: set[str] = set()  # raw elements that nothing closes from here on
    pieces: list[str] = []
    linked = total = links = 0
    balanced = True

    def flush() -> None:
        nonlocal linked, total
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        if text:
            path = (*far, *(w for o in stack[-_NEAR:] if o.name not in INLINE for w in o.words))
            mark = next((o.mark for o in reversed(stack) if o.mark is not None), None) if marked else None
            out.append(Block(text, path, linked / max(total, 1), mark))
        pieces.clear()
        linked = total = 0

    def pop() -> str:
        nonlocal links
        name = stack.pop().name
        places[name].pop()
        links -= name == "a"
        if len(stack) >= _NEAR and stack[-_NEAR].name not in INLINE:
            for w in stack[-_NEAR].words:
                far[w] -= 1
                if not far[w]:
                    del far[w]
        return name

    def push(element: _Open) -> None:
        nonlocal links
        if len(stack) >= _NEAR and stack[-_NEAR].name not in INLINE:
            for w in stack[-_NEAR].words:
                far[w] = far.get(w, 0) + 1
        places.setdefault(element.name, []).append(len(stack))
        stack.append(element)
        links += element.name == "a"

    def last(names: set[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    at, end = 0, len(page)
    while at < end:
        tag = page.find("<", at)
        tag = end if tag < 0 else tag
        if tag > at:
            pieces.append(page[at:tag])
            total += tag - at
            linked += (tag - at) if links else 0
        if tag == end:
            break
        following = page[tag + 1 : tag + 2]
        if page.startswith("<!--", tag):
            close = page.find("-->", tag + 4)
            at = end if close < 0 else close + 3
            continue
        if following in ("!", "?") and following:
            close = page.find(">", tag)
            at = end if close < 0 else close + 1
            continue
        found = _NAME.match(page, tag)
        if not found:
            pieces.append("<")
            at = tag + 1
            continue
        whole = _TAG.match(page, tag) if balanced else None
        if whole:
            at = whole.end()
        else:
            balanced = False
            close = page.find(">", tag)
            at = end if close < 0 else close + 1
        name = found[1].lower()
        inline = name in INLINE
        if following == "/":
            if not inline:
                flush()
            if places.get(name):
                if not inline or stack[-1].name == name:
                    while pop() != name:
                        pass
                elif inline:
                    # an inline tag closes only inside its block
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k].name not in INLINE:
                            break
                        if stack[k].name == name:
                            while pop() != name:
                                pass
                            break
            continue
        if name in RAW:
            flush()
            close = -1 if name in unclosed else lowered.find(f"</{name}", at)
            if close < 0:
                unclosed.add(name)
                at = end if name in ("script", "style", "textarea", "title") else at
            else:
                stop = page.find(">", close)
                at = end if stop < 0 else stop + 1
            continue
        if not inline:
            flush()
            closed = _ENDS.get(name, {"p"})
            scope = _SCOPE.get(name, set())
            while (k := last(closed)) > last(scope):
                while len(stack) > k:
                    pop()
                if name not in _ENDS or name in ("li", "option"):
                    break
        if name in VOID:
            continue
        words, mark = [name], None
        if not inline:
            for key, value in _ATTRIBUTE.findall(page, found.end(), at):
                value = value.strip("\"'")
                if key.lower() != "data-y":
                    words += ["." + w.lower() for w in _PART.findall(value)]
                elif marked:
                    mark = int(value == "1")
        push(_Open(name, tuple(words), mark))
    flush()
    return out
