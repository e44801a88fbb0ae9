"""Many selectors over a page in one walk: they are matched while the page is parsed."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

from guildbook.operators.people import Elements

_PART = re.compile(r"""(?P<tag>^[\w-]+|^\*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>[*^$~]?=)['"]?(?P<val>[^'"\]]*)['"]?)?\]|:not\((?P<no>[^)]*)\)""")
_PREDICATE = re.compile(r"""\[\s*(?:(?P<nth>\d+)|@(?P<attr>[\w:-]+)(?:\s*=\s*(?P<q>['"])(?P<val>.*?)(?P=q))?|contains\(\s*@(?P<has>[\w:-]+)\s*,\s*(?P<q2>['"])(?P<part>.*?)(?P=q2)\s*\))\s*\]""")
_STEP = re.compile(r"(?P<way>//?)(?:(?P<text>text\(\))|@(?P<get>[\w:-]+)|(?P<tag>[\w-]+|\*)(?P<preds>(?:\[[^\]]*\])*))")


def conditions_of(word: str, selector: str) -> tuple[dict, ...]:
    """One step of a CSS selector: what an element must meet."""
    found, at = [], 0
    while at < len(word):
        m = _PART.match(word, at) if at else _PART.match(word)
        if m is None:
            raise ValueError(f"not a selector of this kind: {selector}")
        found.append(m.groupdict())
        at = m.end()
    return tuple(found)


def holds(row: dict, conditions) -> bool:
    for x in conditions:
        if x.get("nth"):
            if row["nth"] != x["nth"]:
                return False
            continue
        if x["tag"] and x["tag"] not in ("*", row["tag"]) or x["cls"] and x["cls"] not in row["classes"] or x["id"] and x["id"] != row["attrs"].get("id"):
            return False
        if x["no"] and holds(row, conditions_of(x["no"], x["no"])):
            return False
        if x["attr"]:
            has, want = row["attrs"].get(x["attr"]), x["val"] or ""
            if has is None:
                return False
            op = x["op"]
            if not (op is None or op == "=" and has == want or op == "*=" and want in has or op == "^=" and has.startswith(want) or op == "$=" and has.endswith(want) or op == "~=" and want in has.split()):
                return False
    return True


def _css(selector: str) -> list[list[tuple[bool, tuple]]]:
    """The ways of a selector (commas), each a list of steps from outside in: whether the step before must be the parent, conditions."""
    ways = []
    for part in re.findall(r"(?:[^,\[(]|\[[^\]]*\]|\([^)]*\))+", selector):
        steps, near = [], False
        for word in re.findall(r"""(?:[^\s\[>]|\[[^\]]*\])+|>""", part):
            if word == ">":
                near = True
                continue
            steps.append((near, conditions_of(word, selector)))
            near = False
        if not steps or near or steps[0][0]:
            raise ValueError(f"not a selector of this kind: {selector}")
        ways.append(steps)
    return ways


_ANY = {"tag": None, "cls": None, "id": None, "attr": None, "op": None, "val": None, "no": None}


def _xpath(selector: str) -> tuple[list[list[tuple[bool, tuple]]], str | None]:
    """The steps of a path of the subset //tag, /tag, *, [@a], [@a='v'], [contains(@a, 'v')], [n], with /@a or /text() at its end; and
    what is taken of the element: None for its first text, @a for an attribute."""
    steps, at, take = [], 0, None
    while at < len(selector):
        m = _STEP.match(selector, at)
        if m is None or take is not None or (m["way"] == "//" and not m["tag"]):
            raise ValueError(f"not a path of this kind: {selector}")
        at = m.end()
        if m["text"] or m["get"]:
            take = "text()" if m["text"] else f"@{m['get']}"
            continue
        held, inner = [_ANY | {"tag": m["tag"]}], 0
        while inner < len(m["preds"]):
            p = _PREDICATE.match(m["preds"], inner)
            if p is None:
                raise ValueError(f"not a path of this kind: {selector}")
            inner = p.end()
            if p["nth"]:
                held.append({"nth": int(p["nth"])})
            elif p["has"]:
                held.append(_ANY | {"attr": p["has"], "op": "*=", "val": p["part"]})
            else:
                held.append(_ANY | {"attr": p["attr"], "op": None if p["val"] is None else "=", "val": p["val"]})
        steps.append((m["way"] == "/", tuple(held)))
    if not steps:
        raise ValueError(f"not a path of this kind: {selector}")
    return [steps], None if take == "text()" else take


class Rules:
    """Selectors as steps, each with a bit. A step is filed under the id, class or tag that it asks for, so that an element is held
    against few of them; the bits of what the parent and all open elements meet tell whether the steps outside are met."""

    def __init__(self, selectors: tuple[str, ...]):
        self.selectors = selectors
        self.takes: list[str | None] = []
        self.steps: list[tuple[int, bool, tuple, int | None]] = []
        self.filed: dict[str, list[int]] = {}
        for number, selector in enumerate(selectors):
            path = selector.startswith("/")
            ways, take = _xpath(selector) if path else (_css(selector), None)
            self.takes.append(take if take or not path else "text")
            for steps in ways:
                needs = 0  # bit of the step outside; 0 for none
                for k, (near, held) in enumerate(steps):
                    self.steps.append((needs, near, held, number if k == len(steps) - 1 else None))
                    self.filed.setdefault(self._place(held), []).append(len(self.steps) - 1)
                    needs = 1 << (len(self.steps) - 1)

    @staticmethod
    def _place(held) -> str:
        for x in held:
            if x.get("id"):
                return f"#{x['id']}"
        for x in held:
            if x.get("cls"):
                return f".{x['cls']}"
        tag = held[0].get("tag")
        return tag if tag and tag != "*" else ""

    def meet(self, row: dict, near: int, around: int, top: bool) -> tuple[int, list[int]]:
        """The bits of the steps that an element meets, and the selectors that it is found by. near, around: the bits of its parent, and
        of all that is open around it."""
        filed, own, found = self.filed, 0, []
        places = ["", row["tag"], *[f".{x}" for x in dict.fromkeys(row["classes"])]]
        if "id" in row["attrs"]:
            places.append(f"#{row['attrs']['id']}")
        for place in places:
            for k in filed.get(place, ()):
                needs, parent, held, out = self.steps[k]
                if (needs & (near if parent else around) if needs else not parent or top) and holds(row, held):
                    own |= 1 << k
                    if out is not None and out not in found:
                        found.append(out)
        return own, found


@lru_cache(maxsize=256)
def rules(selectors: tuple[str, ...]) -> Rules:
    return Rules(selectors)


class Matched(Elements):
    """A page with the elements that each selector finds, in order. With digests it also keeps a digest of each found element with all
    that it holds, and the shape of the tree (tags and sorted classes) down to five levels below the body."""

    LEVELS = 5

    def __init__(self, selectors: Rules, digests: bool = False):
        super().__init__()
        self.selectors, self.digests = selectors, digests
        self.hits: list[list[int]] = [[] for _ in selectors.selectors]
        self.masks: list[tuple[int, int]] = [(0, 0)]
        self.counts: list[dict[str, int]] = [{}]
        self.owners: list[int | None] = []
        self.held: dict[int, tuple] = {}  # of open elements: digest so far, shapes of what is inside
        self.shapes: list[str] = []
        self.body: str | None = None

    def handle_starttag(self, tag, attrs):
        depth, i = len(self.open), len(self.rows)
        if self.digests:
            start = hashlib.sha256(repr((tag, sorted((k, v or "") for k, v in attrs))).encode())
            up = self.rows[self.open[-1]]["level"] if self.open else (False, 0)
            self.held[i] = (start, [], (True, 0) if tag == "body" and not up[0] else (up[0], up[1] + 1))
        super().handle_starttag(tag, attrs)
        row, counts = self.rows[i], self.counts[depth]
        row["nth"] = counts[tag] = counts.get(tag, 0) + 1
        own, found = self.selectors.meet(row, *self.masks[-1], depth == 0)
        for k in found:
            self.hits[k].append(i)
        if len(self.open) > depth:
            self.masks.append((own, self.masks[-1][1] | own))
            self.counts.append({})

    def added(self, row: dict, i: int) -> None:
        if self.digests:
            row["level"] = self.held[i][2]

    def handle_endtag(self, tag):
        super().handle_endtag(tag)
        del self.masks[len(self.open) + 1 :], self.counts[len(self.open) + 1 :]

    def handle_data(self, data):
        before = len(self.pieces)
        super().handle_data(data)
        if len(self.pieces) > before:
            self.owners.append(self.open[-1] if self.open else None)
        if self.digests and self.open:
            self.held[self.open[-1]][0].update(b"text" + data.encode("utf-8", "surrogatepass"))

    def _shut(self, i: int):
        super()._shut(i)
        if not self.digests:
            return
        digest, inside, (in_body, level) = self.held.pop(i)
        row = self.rows[i]
        row["digest"] = digest.hexdigest()
        shape = f"<{row['tag']} class='{'.'.join(sorted(row['classes']))}'>{''.join(inside)}</{row['tag']}>" if level <= self.LEVELS else ""
        if in_body and level == 0 and self.body is None:
            self.body = shape
        if row["parent"] is None:
            self.shapes.append(shape)
        else:
            up = self.held[row["parent"]]
            up[0].update(digest.digest())
            if shape:
                up[1].append(shape)

    def structure(self) -> str:
        """The shape of the body, or of the page where it has none."""
        return self.body if self.body is not None else f"<[document] class=''>{''.join(self.shapes)}</[document]>"

    def found(self, k: int, box: int | None = None) -> list[int]:
        """The elements of selector k, of the page or inside one of its elements."""
        hits = self.hits[k]
        return hits if box is None else hits[bisect_right(hits, box) : bisect_left(hits, self.rows[box]["last"])]

    def value(self, k: int, extract: str | None = None, box: int | None = None) -> str | None:
        """What selector k gives: an attribute, or the text of its first element; of a path the text before any element inside."""
        found = self.found(k, box)
        if not found:
            return None
        row, take = self.rows[found[0]], self.selectors.takes[k]
        if take and take.startswith("@"):
            return row["attrs"].get(take[1:])
        if extract:
            return row["attrs"].get(extract)
        if take is None:
            return " ".join(self.text(found[0]).split())
        first = self.rows[found[0] + 1]["from"] if row["last"] > found[0] + 1 else row["to"]
        own = [p for p, o in zip(self.pieces[row["from"] : first], self.owners[row["from"] : first], strict=True) if o == found[0]]
        return "".join(own) or None


def read(html: str, selectors: Rules, digests: bool = False) -> Matched:
    page = Matched(selectors, digests)
    page.feed(html)
    page.close()
    return page
