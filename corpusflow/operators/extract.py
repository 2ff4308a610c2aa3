"""X0-X26 / XO1-XO10: article body extraction with a rule table.

Only tree selection runs in Python: an Arrow UDF parses each page once (stdlib
``html.parser``), whatever the number of rules asked of it, and
returns for every rule the text *pieces* it selects (paragraph texts, or one
text per container) plus which container matched. Elements are numbered in
document order and kept by tag, so a selector looks at the elements of its tag
only, and what a rule drops is left out of its own view of the tree.
Everything after that -- dropping the last paragraphs, skipping paragraphs
that contain a phrase, literal and regex deletes, joiners and suffixes,
whitespace collapsing, trimming, the missing-container and status policies
-- is a native Column expression driven by the rule row.

Tree rules mirror the ``html.parser`` tree builder the reference used:

* an end tag closes the most recent open element of that name (and
  everything opened after it); an unmatched end tag is ignored, so an
  unclosed ``<p>`` nests the next ``<p>`` and paragraph texts overlap;
* void elements close at once; ``script``/``style`` bodies are raw text;
* a string made only of ASCII whitespace becomes ``'\\n'`` (if it held a
  newline) or ``' '``;
* ``get_text`` skips comments and ``script``/``style``/``template``/``rt``/``rp``
  strings of descendants; ``strip=True`` strips each string and drops the
  empty ones;
* a class selector matches one class of the element or the whole
  space-joined class list (so a multi-class selector needs that exact order);
* ``find`` is the first match in document order, ``find_all`` all matches
  (nested matches included).
"""

from __future__ import annotations

from html.entities import html5 as _HTML5
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions.batches import sliced

VOID = frozenset("area base br col embed hr img input keygen link meta param source track wbr".split())
HIDDEN_STRINGS = frozenset(("script", "style", "template", "rt", "rp"))
PRESERVE_WS = frozenset(("pre", "textarea"))
_ASCII_WS = str.maketrans("", "", " \n\t\x0c\r")
# entity names known without their ';' (``&name`` followed by a non-name
# character is decoded only when the name is known; otherwise kept as text)
_ENTITIES = {k[:-1]: v for k, v in _HTML5.items() if k.endswith(";")}


class Node:
    """An element; its descendants are those numbered ``order + 1`` to ``end``. ``by_tag`` is its
    page's list of elements per tag, in document order (None: of any tag)."""
    __slots__ = ("tag", "attrs", "children", "classes", "order", "end", "by_tag")

    def __init__(self, tag, attrs, order, by_tag):
        self.by_tag = by_tag
        self.tag = tag
        self.attrs = attrs
        self.children = []
        self.order = self.end = order
        cls = attrs.get("class")
        self.classes = cls.split() if cls is not None else None


class Text(str):
    """A string node; ``kind`` is ``text``, ``hidden`` or ``comment``."""
    __slots__ = ("kind",)


def _text(s, kind):
    t = Text(s)
    t.kind = kind
    return t


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.n, self.by_tag = 0, {None: []}
        self.root = Node("[document]", {}, 0, self.by_tag)
        self.stack = [self.root]
        self.buf = []

    def _flush(self):
        if not self.buf:
            return
        s = "".join(self.buf)
        self.buf = []
        names = {n.tag for n in self.stack}
        if s.translate(_ASCII_WS) == "" and not (names & PRESERVE_WS):
            s = "\n" if "\n" in s else " "
        cur = self.stack[-1]
        kind = "hidden" if cur.tag in HIDDEN_STRINGS else "text"
        cur.children.append(_text(s, kind))

    def handle_starttag(self, tag, attrs):
        self._flush()
        d = {k: "" if v is None else v for k, v in attrs}  # of a repeated attribute the last counts
        self.n += 1
        n = Node(tag, d, self.n, self.by_tag)
        self.by_tag[None].append(n)
        self.by_tag.setdefault(tag, []).append(n)
        self.stack[-1].children.append(n)
        if tag not in VOID:
            self.stack.append(n)

    def handle_startendtag(self, tag, attrs):
        self._flush()
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._pop_to(tag)

    def handle_endtag(self, tag):
        self._flush()
        self._pop_to(tag)

    def _pop_to(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._end(i)
                return

    def _end(self, i):
        for n in self.stack[i:]:
            n.end = self.n
        del self.stack[i:]

    def handle_data(self, data):
        self.buf.append(data)

    def handle_entityref(self, name):
        ch = _ENTITIES.get(name)
        self.buf.append(ch if ch is not None else "&" + name)

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[:1] in "xX" else int(name)
        except ValueError:
            self.buf.append("&#" + name)
            return
        ch = None
        if code < 256:
            try:  # 128-159 are read as windows-1252, like browsers do
                ch = bytes([code]).decode("windows-1252")
            except UnicodeDecodeError:
                ch = None
        if ch is None:
            try:
                ch = chr(code)
            except (ValueError, OverflowError):
                ch = "\N{REPLACEMENT CHARACTER}"
        self.buf.append(ch)

    def unknown_decl(self, data):
        if data[:6].upper() == "CDATA[":
            self.buf.append(data[6:])

    def handle_comment(self, data):
        if data[:7].upper() == "[CDATA[":  # newer parsers report it as a comment
            self.buf.append(data[7:-2] if data.endswith("]]") else data[7:])
            return
        self._flush()
        self.stack[-1].children.append(_text(data, "comment"))

    def close(self):
        super().close()
        self._flush()
        self._end(0)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def _matches(n: Node, sel: dict) -> bool:
    if sel.get("tag") and n.tag != sel["tag"]:
        return False
    if sel.get("id") is not None and n.attrs.get("id") != sel["id"]:
        return False
    want = sel.get("cls")
    if want is not None:
        if n.classes is None:
            return False
        if want not in n.classes and " ".join(n.classes) != want:
            return False
    sub = sel.get("cls_contains")
    if sub is not None:
        if n.classes is None or sub not in " ".join(n.classes):
            return False
    return True


def find_all(node: Node, sel: dict, without=()) -> list:
    """Matching descendants in document order; ``without``: elements left out, with all below
    them, where they are below ``node``."""
    own = [n for n in node.by_tag.get(sel.get("tag"), ()) if node.order < n.order <= node.end and _matches(n, sel)]
    gone = [d for d in without if node.order < d.order <= node.end]
    return [n for n in own if not any(d.order <= n.order <= d.end for d in gone)] if gone else own


def find(node: Node, sel: dict):
    return next(iter(find_all(node, sel)), None)


def get_text(node: Node, separator: str = "", strip: bool = False, without=()) -> str:
    own_hidden = node.tag in HIDDEN_STRINGS
    out = []
    stack = list(reversed(node.children))
    while stack:
        c = stack.pop()
        if isinstance(c, Node):
            if c not in without:
                stack.extend(reversed(c.children))
            continue
        if c.kind == "comment" or (c.kind == "hidden" and not own_hidden):
            continue
        s = str(c)
        if strip:
            s = s.strip()
            if not s:
                continue
        out.append(s)
    return separator.join(out)


def select_pieces(page: Node | str, rule: dict):
    """Apply a rule's tree part: ``(level, pieces)``; level 0 = no container,
    1 = main container, 2 = fallback container. A parsed page is left as it is."""
    root, gone = parse(page) if isinstance(page, str) else page, set()
    level = 1
    cont = rule.get("container")
    if cont is None:
        containers = [root]
    else:
        containers = find_all(root, cont)[:None if rule.get("container_all") else 1]
    if containers and rule.get("inner"):
        containers = find_all(containers[0], rule["inner"])[:1]
    if not containers and rule.get("fallback"):
        containers = find_all(root, rule["fallback"])[:1]
        level = 2
    if not containers:
        return 0, []
    for c in containers:
        for sel in rule.get("drops") or []:
            gone.update(find_all(c, sel, gone))
    strip = bool(rule.get("strip"))
    pieces = []
    if rule.get("text_mode") == "all":
        for c in containers:
            pieces.append(get_text(c, rule.get("separator") or "", strip, gone))
    else:
        para = rule.get("para") or {"tag": "p"}
        for c in containers:
            for p in find_all(c, para, gone):
                for sel in rule.get("para_drops") or []:
                    gone.update(find_all(p, sel, gone))
                pieces.append(get_text(p, "", strip, gone))
    return level, pieces


SELECTED = T.ArrayType(T.StructType([T.StructField("rule_id", T.StringType()), T.StructField("level", T.IntegerType()),
                                     T.StructField("pieces", T.ArrayType(T.StringType())), T.StructField("error", T.StringType())]))
_SELECTED = pa.list_(pa.struct([("rule_id", pa.string()), ("level", pa.int32()), ("pieces", pa.list_(pa.string())), ("error", pa.string())]))


def pieces_udf(rules: dict[str, dict]):
    """Pandas UDF ``(html, rule ids) -> array of (rule_id, level, pieces, error)``: one parse a
    page, whose tree goes before the next one. The rule dict is small config shipped with the
    function."""

    def select(page, rule_id):
        rule = rules.get(rule_id)
        if page is None or rule is None:
            return {"rule_id": rule_id, "level": 0, "pieces": [], "error": None if page is None else "unknown rule"}
        try:
            if isinstance(page, Exception):
                raise page
            level, pieces = select_pieces(page, rule)
            return {"rule_id": rule_id, "level": level, "pieces": pieces, "error": None}
        except Exception as e:  # noqa: BLE001 -- quarantined, not fatal
            return {"rule_id": rule_id, "level": 0, "pieces": [], "error": f"{type(e).__name__}: {e}"}

    def parsed(html):
        try:
            return None if html is None else parse(html)
        except Exception as e:  # noqa: BLE001
            return e

    @F.pandas_udf(SELECTED)
    def _pieces(html: pd.Series, asked: pd.Series) -> pd.Series:
        out = []
        for h, ids in zip(html, asked):
            page = parsed(h)
            out.append([select(page, i) for i in ids])
            if isinstance(page, Node):
                page.by_tag.clear()  # every element refers to this index: without it no cycle holds the tree
        return pd.Series(out, dtype=object)

    return _pieces


def finish_text(pieces: Column, level: Column, r: Column) -> Column:
    """XO5-XO10 from the rule row ``r`` (a struct column of RULES)."""
    n_drop = F.when(level == 2, F.coalesce(r["fallback_drop_last"], F.lit(0))) \
              .otherwise(F.coalesce(r["drop_last"], F.lit(0)))
    ps = F.when(n_drop > 0, F.slice(pieces, 1, F.greatest(F.size(pieces) - n_drop, F.lit(0)))).otherwise(pieces)
    skip = F.coalesce(r["skip_if_contains"], F.array().cast("array<string>"))
    ps = F.filter(ps, lambda p: ~F.exists(skip, lambda s: F.contains(p, s)))
    per_piece = F.coalesce(r["piece_deletes"], F.array().cast("array<string>"))
    ps = F.transform(ps, lambda p: F.aggregate(per_piece, p, lambda acc, s: F.replace(acc, s, F.lit(""))))
    suffix = F.coalesce(r["suffix"], F.lit(""))
    # SQL array_join takes a per-row delimiter (the Python wrapper wants a literal)
    text = F.call_function("array_join", F.transform(ps, lambda p: F.concat(p, suffix)),
                           F.coalesce(r["joiner"], F.lit("")))
    lits = F.coalesce(r["literal_deletes"], F.array().cast("array<string>"))
    text = F.aggregate(lits, text, lambda acc, s: F.replace(acc, s, F.lit("")))
    regs = F.coalesce(r["regex_deletes"], F.array().cast("array<string>"))
    text = F.aggregate(regs, text, lambda acc, p: F.regexp_replace(acc, F.concat(F.lit("(?dU)"), p), F.lit("")))
    text = F.when(F.coalesce(r["collapse"], F.lit(False)), tx.squeeze(text)).otherwise(text)
    text = F.when(F.coalesce(r["trim"], F.lit(False)), tx.trim_ws(text)).otherwise(text)
    missing = F.when(r["missing"] == "empty", F.lit("")).otherwise(F.lit(None).cast("string"))
    return F.when(level == 0, missing).otherwise(text)


def rules_map(rules: dict[str, dict]) -> Column:
    """The rule table as a literal ``map<rule_id, struct>`` (fixed config of a
    few dozen rows): looked up per row, folded once by the optimizer, no join."""
    import json

    from ..sources.registry import RULES_SCHEMA
    ids = sorted(rules)
    vals = [F.from_json(F.lit(json.dumps({f.name: rules[i].get(f.name) for f in RULES_SCHEMA.fields})),
                        RULES_SCHEMA) for i in ids]
    return F.map_from_arrays(F.array(*[F.lit(i) for i in ids]), F.array(*vals))


def _body(r: Column, x: Column, status: Column | None, landed: Column) -> Column:
    """Content by a rule row ``r`` from what was selected ``x``; NULL is a failed extraction."""
    body = finish_text(x["pieces"], x["level"], r)
    if status is not None:
        ok = F.when(r["status_policy"] == "none", F.lit(True)).when(r["status_policy"] == "lt400", status < 400).otherwise(status == 200)
        body = F.when(F.coalesce(ok, F.lit(False)), body)
    # no landed page (url missing from pages) is a failed request: NULL,
    # whatever the rule's missing-container policy says
    return F.when(landed & x["error"].isNull(), body)


def extract_all(pages: DataFrame, rules: dict[str, dict], asked_col: str = "rules", status_col: str = "status") -> DataFrame:
    """Pages with the rules asked of each (``ARRAY<STRING>``) -> one row per page and rule:
    ``rule_id``, ``content`` (NULL = failed extraction) and ``extract_error``. Callers pass pages
    deduplicated on url; a page is parsed once, and its html is not copied to the rule rows."""
    from ..session import ship_package
    ship_package(pages.sparkSession)
    keep = [c for c in pages.columns if c not in ("html", asked_col)]
    asked = F.coalesce(F.col(asked_col), F.array().cast("array<string>"))
    one = pages.select(*keep, F.col("html").isNotNull().alias("_landed"), sliced(pieces_udf(rules), _SELECTED)(F.col("html"), asked).alias("_all"))
    rows = one.select(*keep, "_landed", F.explode("_all").alias("_x"))
    rows = rows.withColumn("_r", F.try_element_at(rules_map(rules), F.col("_x.rule_id")))
    status = F.col(status_col) if status_col in pages.columns else None
    return rows.select(*keep, F.col("_x.rule_id").alias("rule_id"), _body(F.col("_r"), F.col("_x"), status, F.col("_landed")).alias("content"),
                       F.col("_x.error").alias("extract_error"))


def extract_bodies(pages: DataFrame, rules: dict[str, dict],
                   rule_col: str = "rule_id", status_col: str = "status") -> DataFrame:
    """Pages with one rule each -> the same rows with ``content`` (NULL = failed extraction)
    and ``extract_error``."""
    from ..session import ship_package
    ship_package(pages.sparkSession)
    j = pages.withColumn("_r", F.try_element_at(rules_map(rules), F.col(rule_col)))
    j = j.withColumn("_x", F.get(sliced(pieces_udf(rules), _SELECTED)(F.col("html"), F.array(rule_col)), 0))
    status = F.col(status_col) if status_col in pages.columns else None
    return (j.withColumn("content", _body(F.col("_r"), F.col("_x"), status, F.col("html").isNotNull()))
             .withColumn("extract_error", F.col("_x.error"))
             .drop("_x", "_r"))


__all__ = ["parse", "find", "find_all", "get_text", "select_pieces", "extract_all", "extract_bodies", "finish_text", "pieces_udf"]
