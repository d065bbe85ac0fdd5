"""Markup residue in text: a parser for mixed wiki, HTML, Markdown and LaTeX
text, and content selection by tag-path ratios.

The text is read once into nodes ``(path, kind, text)``; ``path`` is the
root-to-leaf tag path: the open tags that hold the whole node. Text outside of
all tags is ``body/p``, and what other syntaxes mark has the names heading,
list, code, formula, table, item and template.  Lengths of text and numbers of punctuation marks are
added up per path, both ratios are smoothed along the document, fused into one
score, and paths under the threshold (templates, captions, notes, navigation)
are dropped.  Headings, lists, code, formulas and tables always stay.

Everything happens inside one row, so the operator is a narrow stage without
any shuffle.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ELEMENTS = ("heading", "list", "code", "formula", "table", "inline")

# Names of tags that count as markup; another "<word" is prose.
INLINE_TAGS = (
    "a abbr acronym address article aside b bdi bdo big blockquote body br button caption center cite code col "
    "colgroup dd del dfn div dl dt em figcaption figure font footer form gallery head header hr html i iframe "
    "img input ins kbd label li link main mark meta nav noinclude includeonly nowiki ol option p poem q ref "
    "references rp rt ruby s samp script section select small span strike strong style sub summary sup tbody td "
    "tfoot th thead time title tr tt u ul var wbr"
).split()
# Tags that end a paragraph, and tags that are no part of a path: those without content and those of the page or the wiki.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd div dl dt figcaption figure footer form gallery head header html li main nav ol option "
    "p poem section select summary table tbody td tfoot th thead tr ul".split()
)
PATHLESS_TAGS = frozenset("body br col head hr html img includeonly input link meta noinclude nowiki wbr".split())
# Tags around plain prose, and the names of text outside of tags and of a lone item.
PROSE_TAGS = frozenset("article blockquote body div dd item li main p section td".split())
DEPTH = 512  # of the tags that are kept open, as in browsers; a deeper tag adds nothing to the path
# LaTeX environments by kind.
CODE_ENVS = "verbatim|lstlisting|minted|Verbatim"
MATH_ENVS = "equation|align|displaymath|gather|eqnarray|multline|math"
TABLE_ENVS = "tabular|tabularx|longtable|array"
LIST_ENVS = "itemize|enumerate|description"

_S, _E = "\x01", "\x02"  # brackets of a placeholder for a block taken out of the text
_PLACE = re.compile(f"{_S}(\\d+){_E}")
_M = "\x03"  # brackets of a placeholder for a tag of a line
_MARK = re.compile(f"{_M}(\\d+){_M}")

_LEAF = re.compile(
    rf"""
    (?P<comment><!--.*?(?:-->|\Z))
  | <(?P<pre>pre|syntaxhighlight|source)\b(?![^>]*/>)[^>]*>(?P<precode>.*?)</(?P=pre)\s*>
  | ^(?P<fence>`{{3,}}|~{{3,}})[^\n`]*\n(?P<fcode>.*?)(?:^(?P=fence)[ \t]*$|\Z)
  | \\begin\{{(?P<venv>(?:{CODE_ENVS})\*?)\}}(?P<vcode>.*?)\\end\{{(?P=venv)\}}
  | <math\b(?P<mattr>[^>]*)>(?P<math>.*?)</math\s*>
  | <chem\b[^>]*>(?P<chem>.*?)</chem\s*>
  | \$\$(?P<dd>.+?)\$\$
  | (?<!\\)\\\[(?P<db>.+?)\\\]
  | (?<!\\)\\\((?P<ib>.+?)\\\)
  | \\begin\{{(?P<menv>(?:{MATH_ENVS})\*?)\}}(?P<mcode>.*?)\\end\{{(?P=menv)\}}
  | (?<![\\$\w])\$(?P<id>(?![\s$\d])[^$\n]*?(?<![\s\\]))\$(?![\d$])
  | (?<![\\$\w])\$(?P<idn>\d[^$\n]*?[\\^_=+{{}}][^$\n]*?(?<![\s\\]))\$(?![\d$])
    """,
    re.S | re.M | re.X | re.I,
)
_GROUP = re.compile(
    rf"""
    (?P<wtable>^[ \t:]*\{{\|.*?^[ \t]*\|\}})
  | (?P<htable><table\b[^>]*>.*?</table\s*>)
  | \\begin\{{(?P<tenv>(?:{TABLE_ENVS})\*?)\}}(?P<ttable>.*?)\\end\{{(?P=tenv)\}}
  | \\begin\{{(?P<lenv>(?:{LIST_ENVS}))\}}(?P<llist>.*?)\\end\{{(?P=lenv)\}}
  | (?P<hlist><(?:ul|ol|dl)\b[^>]*>)
  | <h(?P<hl>[1-6])\b[^>]*>(?P<hh>.*?)</h(?P=hl)\s*>
  | \\(?P<sec>part|chapter|section|subsection|subsubsection|paragraph)\*?(?:\[[^\]\n]*\])?\{{(?P<sh>[^{{}}\n]*)\}}
    """,
    re.S | re.M | re.X | re.I,
)
_LIST_TAG = re.compile(r"<(/?)(?:ul|ol|dl)\b[^>]*>", re.I)
_LI_END = re.compile(r"</(?:li|dt|dd)\s*>", re.I)
_LI = re.compile(r"<(?:li|dt|dd)\b[^>]*>", re.I)
_WIKI_HEAD = re.compile(r"^[ \t]*(={1,6})[ \t]*(?P<h>[^=\s](?:[^\n]*?[^=\s])?)[ \t]*\1[ \t]*$")
_ATX = re.compile(r"^ {0,3}(#{1,6})[ \t]+(?P<h>\S[^\n]*?)[ \t]*#*[ \t]*$")
_HASH = re.compile(r"^#+[ \t]*\S")
_SETEXT = re.compile(r"^ {0,3}(=+|-+)[ \t]*$")
_ITEM = re.compile(r"^(?:[ \t]*[-+*•][ \t]+|[ \t]*\d{1,4}[.)][ \t]+|[*#:;]+[ \t]*)(?=\S)")
_STAR = re.compile(r"^\*+(?=\S)")
_MD_RULE = re.compile(r"^[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)*\|?[ \t]*$")
_HR = re.compile(r"^[ \t]*(?:-{4,}|(?:-[ \t]*){3,}|(?:\*[ \t]*){3,}|(?:_[ \t]*){3,})$")
_QUOTE = re.compile(r"^ {0,3}>+[ \t]?")
_SPECIAL = re.compile(r"[<&\\'*_`\[\]{}~]|https?:")
_TAG = re.compile(rf"</?(?:{'|'.join(INLINE_TAGS)})\b(?:\s[^<>]*)?/?>", re.I)
_REF = re.compile(r"<ref\b[^<>]*?/>|<ref\b[^<>]*>.*?</ref\s*>|<(script|style)\b[^<>]*>.*?</\1\s*>", re.S | re.I)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]{1,30});", re.I)
_TEMPLATE = re.compile(r"\{\{[^{}]*\}\}")
_FILE = re.compile(r"\[\[(?:File|Image|Media|Category|Datei|Fichier|Archivo):(?:[^\[\]]|\[\[[^\[\]]*\]\])*\]\]", re.I)
_LINK = re.compile(r"\[\[([^\[\]|]*)(?:\|([^\[\]]*))?\]\]")
_EXT = re.compile(r"\[(?:https?:|ftp:|mailto:|//)\S+?(?:[ \t]+([^\]\n]*))?\]")
_MD_IMAGE = re.compile(r"!\[([^\]\n]*)\]\([^()\s]*(?:\s+\"[^\"\n]*\")?\)")
_MD_LINK = re.compile(r"\[([^\[\]\n]+)\]\((?:[^()\s]|\([^()\s]*\))*(?:\s+\"[^\"\n]*\")?\)")
_MD_REF = re.compile(r"\[\^[^\]\s]+\]:?|\[([^\[\]\n]+)\]\[[^\[\]\n]*\]|^[ \t]*\[[^\]\n]+\]:[ \t]+\S+.*$", re.M)
_AUTO = re.compile(r"<(https?://[^<>\s]+|mailto:[^<>\s]+)>")
_BARE_QUOTES = re.compile(r"'{2,}")
_TICKS = re.compile(r"`+")
_STRONG = re.compile(r"(?<![\w*\\])(\*\*|\*)(?![\s*])([^*\n]+?)(?<![\s*])\1(?![\w*])")
_UNDERS = re.compile(r"_+")
_UNDER_OPENS = re.compile(r"(?<![\w\\])_+(?=[^\s_])")
_UNDER_CLOSES = re.compile(r"(?<=\S)_+(?!\w)")
_STRIKE = re.compile(r"~~(?![\s~])([^~\n]+?)(?<![\s~])~~")
_TEX_DROP = re.compile(r"\\(?:label|cite[a-z]*|ref|eqref|pageref|index|vspace|hspace|includegraphics|usepackage|documentclass|bibliography(?:style)?|begin|end|footnotemark)\*?(?:\[[^\]\n]*\])*(?:\{[^{}\n]*\})+")
_TEX_HREF = re.compile(r"\\href\{[^{}\n]*\}\{([^{}\n]*)\}")
_TEX_CMD = re.compile(r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{([^{}\n]*)\}")
_TEX_BARE = re.compile(r"\\(?:item|noindent|newline|newpage|par|centering|hline|maketitle|LaTeX|TeX|ldots|dots|quad|qquad|tableofcontents|clearpage|bigskip|medskip|smallskip)\b\*?|\\\\")
_TEX_ESC = re.compile(r"\\([%&_#${}])")
_MAGIC = re.compile(r"__(?:TOC|NOTOC|FORCETOC|NOEDITSECTION)__")
_PUNCT = re.compile(r"[.,;:!?…。、，！？；：]")
_SPACES = re.compile(r"[ \t]{2,}")
_SEC_LEVEL = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4}


def unescape_once(text: str) -> str:
    """Undo the escaping of the dump: one level, XML's own entities only."""
    if "&" not in text:
        return text
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#039;", "'"), ("&#39;", "'")):
        text = text.replace(name, char)
    return text.replace("&amp;", "&")


def _without(line: str, drop: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for a, b in sorted(drop):
        out.append(line[at:a])
        at = b
    return "".join(out) + line[at:]


def _without_ticks(line: str) -> str:
    """The line without the marks of inline code: a run of backticks, or else
    its end, ends at the next run of just that length."""
    runs = [m.span() for m in _TICKS.finditer(line)]
    if len(runs) < 2:
        return line
    by_length: dict[int, list[int]] = {}
    for i, (a, b) in enumerate(runs):
        by_length.setdefault(b - a, []).append(i)
    drop, i = [], 0
    while i < len(runs):
        a, b = runs[i]
        i += 1
        for k in range(b - a, 0, -1):
            same = by_length.get(k, ())
            x = bisect_left(same, i)
            if x < len(same):
                drop += [(b - k, b), runs[same[x]]]
                i = same[x] + 1
                break
    return _without(line, drop)


def _without_underscores(line: str) -> str:
    """The line without the marks of emphasis: a closing mark of one or two
    underscores takes the first opening mark of its length that is left."""
    drop: list[tuple[int, int]] = []
    opened: dict[int, deque[tuple[int, int]]] = {1: deque(), 2: deque()}
    for m in _UNDERS.finditer(line):
        before = opened.get(len(m[0]))
        if before is None:
            continue
        if before and _UNDER_CLOSES.match(line, m.start()):
            drop += [before.popleft(), m.span()]
        elif _UNDER_OPENS.match(line, m.start()):
            before.append(m.span())
    return _without(line, drop)


class _Path:
    """Open tags from the root to the last one."""

    __slots__ = ("depth", "kids", "name", "parent", "text")

    def __init__(self, name: str, parent: _Path | None) -> None:
        self.name, self.parent = name, parent
        self.kids: dict[str, _Path] = {}
        self.depth: int = parent.depth + 1 if parent else 0
        self.text: str = f"{parent.text}/{name}" if parent else name

    def then(self, name: str) -> _Path:
        if name not in self.kids:
            self.kids[name] = _Path(name, self)
        return self.kids[name]

    def shared(self, other: _Path) -> _Path:
        """The tags open in both."""
        a, b = self, other
        while a is not b:
            if a.depth >= b.depth:
                a = a.parent
            else:
                b = b.parent
        return a

    def block(self) -> _Path:
        """Up to the last tag that ends paragraphs."""
        at = self
        while at.parent and at.name not in BLOCK_TAGS:
            at = at.parent
        return at

    def after(self, name: str, closing: bool) -> _Path:
        """The path after a tag. A block ends an open ``p``; an end tag without a start tag changes nothing."""
        if name in PATHLESS_TAGS:
            return self
        at: _Path | None = self
        if closing:
            while at and at.name != name:
                at = at.parent
            return at.parent if at and at.parent else self
        if name in BLOCK_TAGS:
            while at and at.name != "p":
                at = at.parent if at.name not in BLOCK_TAGS else None
        else:
            at = None
        start = at.parent if at else self
        return start.then(name) if start.depth < DEPTH else start


class _Reader:
    """State of reading one text."""

    __slots__ = ("blocks", "found", "nodes", "path", "tags")

    def __init__(self) -> None:
        self.path = _Path("body", None)  # after the tags read so far
        self.tags: list[tuple[bool, _Path]] = []  # of the line: whether it ends a paragraph, path after it
        self.blocks: list[tuple[str, str]] = []
        self.found: set[str] = set()
        self.nodes: list[tuple[str, str, str]] = []

    # -- leaves: code, formulas, comments ---------------------------------
    def _keep(self, kind: str, text: str) -> str:
        self.blocks.append((kind, text))
        return f"{_S}{len(self.blocks) - 1}{_E}"

    def _leaf(self, m: re.Match) -> str:
        d = m.groupdict()
        if d["comment"] is not None:
            self.found.add("inline")
            return ""
        for name in ("precode", "fcode", "vcode"):
            if d[name] is not None:
                self.found.add("code")
                code = d[name]
                if name == "precode":
                    code = re.sub(r"^\s*<code\b[^>]*>|</code\s*>\s*$", "", code)
                    code = html.unescape(code)
                code = self._expand(code).strip("\n")
                return "\n" + self._keep("code", "```\n" + code + "\n```") + "\n"
        self.found.add("formula")
        if d["math"] is not None:
            body, shown = re.sub(r"</?m[a-z]+\b[^>]*>", " ", d["math"]), "block" in (d["mattr"] or "")
        else:
            body = next(d[k] for k in ("chem", "dd", "db", "ib", "mcode", "id", "idn") if d[k] is not None)
            shown = any(d[k] is not None for k in ("dd", "db", "mcode"))
        body = " ".join(body.split())
        if shown:
            return "\n" + self._keep("formula", f"$${body}$$") + "\n"
        return self._keep("inmath", f"${body}$")

    def _expand(self, s: str) -> str:
        while _S in s:
            s = _PLACE.sub(lambda m: self.blocks[int(m[1])][1], s)
        return s

    # -- tables, lists and headings that span lines -----------------------
    def _groups(self, text: str) -> str:
        out, at = [], 0
        while m := _GROUP.search(text, at):
            out.append(text[at : m.start()])
            end, d = m.end(), m.groupdict()
            if d["hlist"] is not None:
                depth, end = 0, len(text)
                for t in _LIST_TAG.finditer(text, m.start()):
                    depth += -1 if t[1] else 1
                    if depth == 0:
                        end = t.end()
                        break
                body = _LI_END.sub("", _LIST_TAG.sub(" ", text[m.start() : end]))
                items = [x for x in _LI.split(body)[1:]]
                out.append(self._list(items, "ol" if d["hlist"][1:3].lower() == "ol" else "ul"))
            elif d["llist"] is not None:
                out.append(self._list(re.split(r"\\item\b(?:\[[^\]\n]*\])?", d["llist"])[1:], "ol" if d["lenv"] == "enumerate" else "ul"))
            elif d["wtable"] is not None:
                out.append(self._table(self._wiki_rows(d["wtable"])))
            elif d["htable"] is not None:
                rows = [[c for c in re.split(r"<t[hd]\b[^>]*>", r, flags=re.I)[1:]] for r in re.split(r"<tr\b[^>]*>", d["htable"], flags=re.I)[1:]]
                out.append(self._table([[re.sub(r"</?t[a-z]+\b[^>]*>", "", c, flags=re.I) for c in r] for r in rows]))
            elif d["ttable"] is not None:
                body = re.sub(r"^\s*(?:\[[^\]\n]*\])?(?:\{[^{}\n]*\})+", "", d["ttable"])
                rows = [re.split(r"(?<!\\)&", re.sub(r"\\(?:hline|toprule|midrule|bottomrule)\b", "", r)) for r in re.split(r"\\\\", body)]
                out.append(self._table(rows))
            elif d["hh"] is not None:
                out.append(self._heading(int(d["hl"]), d["hh"]))
            else:
                out.append(self._heading(_SEC_LEVEL[d["sec"].lower()], d["sh"]))
            at = max(end, m.start() + 1)
        out.append(text[at:])
        return "".join(out)

    def _wiki_rows(self, body: str) -> list[list[str]]:
        rows: list[list[str]] = [[]]
        for line in body.split("\n")[1:]:
            s = line.strip()
            if s.startswith(("|}", "|+")):
                continue
            if s.startswith("|-"):
                rows.append([])
            elif s[:1] in "|!" and s:
                for cell in re.split(r"\|\||!!", s[1:]):
                    left, bar, right = cell.partition("|")
                    rows[-1].append(right if bar and "=" in left and "[[" not in left else cell)
            elif s and rows[-1]:
                rows[-1][-1] += " " + s
        return rows

    def _heading(self, level: int, text: str) -> str:
        self.found.add("heading")
        return "\n" + self._keep("heading", "#" * level + " " + self._inline(text).strip()) + "\n"

    def _list(self, items: list[str], kind: str) -> str:
        items = [x for x in (" ".join(self._inline(i).split()) for i in items) if x]
        if len(items) < 2:
            return "\n" + "\n".join(items) + "\n"
        self.found.add("list")
        lines = (f"{n}. {x}" if kind == "ol" else f"- {x}" for n, x in enumerate(items, 1))
        return "\n" + self._keep("list", "\n".join(lines)) + "\n"

    def _table(self, rows: list[list[str]]) -> str:
        self.found.add("table")
        rows = [[" ".join(self._inline(c).split()) for c in r] for r in rows]
        lines = ["| " + " | ".join(r) + " |" for r in rows if any(r)]
        if len(lines) > 1:
            lines.insert(1, "|" + " --- |" * max(1, max(len(r) for r in rows)))
        return "\n" + self._keep("table", "\n".join(lines)) + "\n"

    # -- marks inside a line ----------------------------------------------
    def _inline(self, s: str) -> str:
        if not _SPECIAL.search(s):
            return s
        before = s
        if "<" in s:
            s = _REF.sub("", s)
            s = _AUTO.sub(r"\1", s)
        if "{{" in s:
            while (t := _TEMPLATE.sub("", s)) != s:
                s = t
        if "[" in s:
            s = _FILE.sub("", s)
            s = _LINK.sub(lambda m: m[1] if m[2] is None else m[2].rpartition("|")[2], s)
            s = _EXT.sub(lambda m: m[1] or "", s)
            s = _MD_IMAGE.sub(r"\1", s)
            s = _MD_LINK.sub(r"\1", s)
            s = _MD_REF.sub(lambda m: m[1] or "", s)
        if "<" in s:
            s = _TAG.sub("", s)
        if "`" in s:
            s = "\n".join(map(_without_ticks, s.split("\n")))
        if "''" in s:
            s = _BARE_QUOTES.sub("", s)
        if "\\" in s:
            s = _TEX_DROP.sub("", s)
            s = _TEX_HREF.sub(r"\1", s)
            while (t := _TEX_CMD.sub(r"\1", s)) != s:
                s = t
            s = _TEX_BARE.sub(" ", s)
            s = _TEX_ESC.sub(r"\1", s)
        if "*" in s:
            while (t := _STRONG.sub(r"\2", s)) != s:
                s = t
        if "_" in s:
            s = _MAGIC.sub("", s)
            s = "\n".join(map(_without_underscores, s.split("\n")))
        if "~~" in s:
            s = _STRIKE.sub(r"\1", s)
        if "&" in s and _ENTITY.search(s):
            s = _ENTITY.sub(lambda m: html.unescape(m[0]), s)
        if s != before:
            self.found.add("inline")
        return s

    def _tag(self, m: re.Match) -> str:
        """A tag's placeholder; the path goes on from it."""
        self.found.add("inline")
        name = m[0].strip("</>").split(None, 1)[0].rstrip("/").lower()
        if not m[0].endswith("/>"):
            self.path = self.path.after(name, m[0][1] == "/")
        self.tags.append((name in BLOCK_TAGS, self.path))
        return f"{_M}{len(self.tags) - 1}{_M}"

    def _tagged(self, line: str) -> str:
        """The line with placeholders for its tags."""
        self.tags = []
        if "<" not in line:
            return line
        t = _REF.sub("", line)
        if t != line:
            self.found.add("inline")
        return _TAG.sub(self._tag, t)

    # -- the lines that remain ---------------------------------------------
    def read(self, text: str) -> None:
        text = unescape_once(text).replace("\r\n", "\n").replace(_S, "").replace(_E, "").replace(_M, "")
        if "<" in text or "$" in text or "\\" in text or "`" in text or "~~~" in text:
            text = _LEAF.sub(self._leaf, text)
        if "{|" in text or "<" in text or "\\" in text:
            text = self._groups(text)
        if "{{" in text:  # templates may span lines
            while (t := _TEMPLATE.sub(self._template, text)) != text:
                text = t
        if "<ref" in text.lower():
            t = _REF.sub("", text)
            if t != text:
                self.found.add("inline")
                text = t
        lines = text.split("\n")
        para: list[str] = []
        over: list[_Path] = []  # paths of the paragraph's text
        i, n = 0, len(lines)

        def flush(leaf: str = "") -> None:
            if para:
                joined = "\n".join(para).strip()
                para.clear()
                if joined:
                    path = over[0]
                    for x in over:
                        path = path.shared(x)
                    at = path.block()
                    if leaf:
                        name = f"{at.text}/{leaf}"
                    else:  # outside of blocks a paragraph has no tag of its own
                        name = path.text if at.parent else "body/p" + path.text[4:]
                    self.nodes.append((name, "text", joined))
            over.clear()

        def add(line: str) -> None:
            """A line of a paragraph; blocks that start or end in it end the paragraph."""
            at = self.path
            line = self._inline(self._tagged(line))
            if not self.tags:
                para.append(self._expand(line))
                over.append(at)
                return
            part, ended = "", False
            pieces = _MARK.split(line)
            for x, piece in enumerate(pieces):
                if x % 2:
                    ends, at = self.tags[int(piece)]
                    if ends:
                        para.append(part)
                        flush()
                        part, ended = "", True
                    continue
                piece = self._expand(piece)
                part += piece
                if piece.strip():
                    over.append(at)
            if part.strip() or not ended:
                para.append(part)

        def pass_tags(*passed: str) -> None:
            """Tags of lines that are no paragraph."""
            for x in passed:
                self._tagged(x)

        def here() -> str:
            return self.path.block().text

        while i < n:
            line = lines[i]
            s = line.strip()
            if not s:
                flush()
                i += 1
                continue
            m = _PLACE.fullmatch(s)
            if m and self.blocks[int(m[1])][0] in ("code", "formula", "list", "table", "heading", "template"):
                flush()
                kind, body = self.blocks[int(m[1])]
                self.nodes.append((f"{here()}/{kind}", kind, self._expand(body)))
                i += 1
                continue
            if m := _WIKI_HEAD.match(line):
                flush()
                self.found.add("heading")
                self.nodes.append((f"{here()}/heading", "heading", "#" * len(m[1]) + " " + self._expand(self._inline(m["h"]))))
                pass_tags(line)
                i += 1
                continue
            if s[0] == "#" and _HASH.match(line):
                j = i
                while j < n and _HASH.match(lines[j]):
                    j += 1
                if j - i == 1:
                    flush()
                    self.found.add("heading")
                    level = len(s) - len(s.lstrip("#"))
                    self.nodes.append((f"{here()}/heading", "heading", "#" * min(level, 6) + " " + self._expand(self._inline(s.strip("#").strip()))))
                    pass_tags(line)
                    i += 1
                    continue
            if _HR.match(line) and not (para and _SETEXT.match(line)):
                flush()
                self.found.add("inline")
                i += 1
                continue
            if i + 1 < n and _SETEXT.match(lines[i + 1]) and len(lines[i + 1].strip()) >= 2 and not para and not _ITEM.match(line) and "|" not in s:
                self.found.add("heading")
                level = 1 if lines[i + 1].strip()[0] == "=" else 2
                self.nodes.append((f"{here()}/heading", "heading", "#" * level + " " + self._expand(self._inline(s))))
                pass_tags(line)
                i += 2
                continue
            if "|" in s and i + 1 < n and "|" in lines[i + 1] and _MD_RULE.match(lines[i + 1]):
                flush()
                j = i + 2
                while j < n and "|" in lines[j] and lines[j].strip():
                    j += 1
                rows = [re.split(r"(?<!\\)\|", x.strip().strip("|")) for x in (lines[i], *lines[i + 2 : j])]
                m = _PLACE.search(self._table(rows))
                self.nodes.append((f"{here()}/table", "table", self._expand(self.blocks[int(m[1])][1])))
                pass_tags(*lines[i:j])
                i = j
                continue
            if _ITEM.match(line) and not self._emphasis_only(line):
                j, items = i, []
                while j < n and lines[j].strip():
                    m = _ITEM.match(lines[j])
                    if m and not self._emphasis_only(lines[j]):
                        items.append((m[0].strip(), lines[j][m.end() :]))
                    elif items and lines[j][:2] == "  ":
                        items[-1] = (items[-1][0], items[-1][1] + " " + lines[j].strip())
                    else:
                        break
                    j += 1
                flush()
                if len(items) >= 2:
                    self.found.add("list")
                    body = "\n".join(
                        (f"{mark} " if mark[0].isdigit() else f"{'  ' * (len(mark) - 1)}- ") + self._expand(self._inline(x)).strip() for mark, x in items
                    )
                    self.nodes.append((f"{here()}/list", "list", body))
                else:
                    para.append(self._expand(self._inline(items[0][1])))
                    over.append(self.path)
                    flush("item")
                pass_tags(*lines[i:j])
                i = j
                continue
            if m := _QUOTE.match(line):
                self.found.add("inline")
                line = line[m.end() :]
            add(line)
            i += 1
        flush()

    def _emphasis_only(self, line: str) -> bool:
        """A line that starts with Markdown emphasis, as in "*word* more", is no item."""
        m = _STAR.match(line)
        return bool(m and _STRONG.match(line))

    def _template(self, m: re.Match) -> str:
        self.found.add("inline")
        if "\n" not in m[0]:
            return ""
        rows = [x.partition("=")[2].strip() or x.strip() for x in m[0][2:-2].split("|")[1:]]
        return "\n" + self._keep("template", " ".join(x for x in rows if x)) + "\n"


def read_markup(text: str | None) -> tuple[list[tuple[str, str, str]], set[str]]:
    """The nodes of a text and the kinds of markup it holds."""
    if not text:
        return [], set()
    r = _Reader()
    r.read(text)
    return r.nodes, r.found


def select_content(nodes: list[tuple[str, str, str]], sigma: float = 1.0, strength: float = 0.5) -> list[tuple[str, str, str]]:
    """Tag-path ratios over the nodes of one text.

    For each path: text length per node and punctuation per node. Both are
    smoothed along the nodes by a Gaussian of ``sigma`` nodes, fused as a
    geometric mean with the path's own ratios, averaged per path and held
    against ``strength`` times the mean of the scores. Paths below it are
    dropped, but for two: structure takes no part and stays, and a path of
    PROSE_TAGS alone, as text outside of all tags, is dropped only where it
    holds no sentence, so short paragraphs beside long blocks are kept.
    """
    prose = [x for x in nodes if x[1] in ("text", "template")]
    if len(prose) < 2:
        return nodes
    stats: dict[str, list[float]] = {}
    for path, _, text in prose:
        s = stats.setdefault(path, [0.0, 0.0, 0.0])
        s[0] += len(text)
        s[1] += len(_PUNCT.findall(text))
        s[2] += 1
    length = [stats[p][0] / stats[p][2] for p, _, _ in prose]
    punct = [stats[p][1] / stats[p][2] for p, _, _ in prose]
    half = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-half, half + 1)]

    def smooth(x: list[float]) -> list[float]:
        out = []
        for i in range(len(x)):
            lo, hi = max(0, i - half), min(len(x), i + half + 1)
            w = kernel[lo - i + half : hi - i + half]
            out.append(sum(a * b for a, b in zip(w, x[lo:hi])) / sum(w))
        return out

    own = [math.sqrt(a * (1 + b)) for a, b in zip(length, punct)]
    near = [math.sqrt(a * (1 + b)) for a, b in zip(smooth(length), smooth(punct))]
    by_path: dict[str, list[float]] = {}
    for (path, _, _), a, b in zip(prose, own, near):
        by_path.setdefault(path, []).append(math.sqrt(a * b))
    fused = {p: sum(v) / len(v) for p, v in by_path.items()}
    every = [fused[p] for p, _, _ in prose]
    limit = strength * sum(every) / len(every)
    sentences = {path for path, kind, text in prose if kind == "text" and _PUNCT.search(text) and PROSE_TAGS.issuperset(path.split("/"))}
    return [x for x in nodes if x[1] not in ("text", "template") or fused[x[0]] >= limit or x[0] in sentences]


def clean_markup(text: str | None) -> tuple[str | None, list[str]]:
    """Clean text with its structure in one plain form, and the kinds of markup found."""
    if text is None:
        return None, []
    nodes, found = read_markup(text)
    kept = select_content(nodes)
    return "\n\n".join(_SPACES.sub(" ", t) if k == "text" else t for _, k, t in kept), [e for e in ELEMENTS if e in found]


def strip_markup(df: DataFrame, text: str = "text", clean: str = "clean_text", elements: str = "elements") -> DataFrame:
    """Add ``clean`` (string) and ``elements`` (array<string>, in the order of ELEMENTS).

    A null text gives a null ``clean`` and empty ``elements``; an empty text
    gives empty ones. Other columns pass through unchanged; columns already
    named ``clean`` or ``elements`` are replaced. Rows are never dropped.
    Headings come out as "# ..", lists as "- .." or "1. ..", code between
    fences, formulas between dollar signs, tables as lines of cells.
    """
    kind = T.StructType([T.StructField("c", T.StringType()), T.StructField("e", T.ArrayType(T.StringType()))])

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [clean_markup(x) for x in batch]
            yield pd.DataFrame({"c": [p[0] for p in pairs], "e": [p[1] for p in pairs]})

    out = df.withColumn("__markup", run.asNondeterministic()(F.col(f"`{text}`")))
    return out.withColumns({clean: F.col("__markup.c"), elements: F.col("__markup.e")}).drop("__markup")
