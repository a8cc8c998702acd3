"""Corpora of binary documents, list files, and text extraction behind an interface."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip


def content_id(content: Column) -> Column:
    """The first 16 hex digits of the content's SHA-256."""
    return F.substring(F.sha2(content, 256), 1, 16)


def scan(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(doc_id, path, sha256, bytes, content) of the files of a folder; one row for each, the id from the content alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(content_id(F.col("content")).alias("doc_id"), "path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"), "content")


def listing(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, bytes, modified) of the files of a folder; nothing of their content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def read_file(path: str) -> bytes:
    """A file's content, by the path that Spark gives it."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        files, name = fs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    else:
        host, _, name = rest.removeprefix("//").partition("/")
        files, base = fs.FileSystem.from_uri(f"{scheme}://{host}")
        name = f"{base.rstrip('/')}/{name}" if base else f"/{name}"
    with files.open_input_stream(name) as stream:
        return stream.read()


def hashed(files: DataFrame) -> DataFrame:
    """(doc_id, path, sha256, bytes, modified): each file is read once, where its row lies, and only its hash leaves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = [hashlib.sha256(read_file(p)).hexdigest() for p in batch["path"]]
            yield pd.DataFrame({"doc_id": [d[:16] for d in digests], "path": batch["path"], "sha256": digests, "bytes": batch["bytes"], "modified": batch["modified"]})

    return files.select("path", "bytes", "modified").mapInPandas(run, "doc_id string, path string, sha256 string, bytes bigint, modified timestamp")


def select_documents(df: DataFrame, wanted: str, key: str = "doc_id", path: str = "path") -> DataFrame:
    """Documents whose id starts with, or whose file name holds, the wanted text."""
    from ..functions.text import basename

    return df.where(F.startswith(F.col(key), F.lit(wanted)) | F.contains(basename(F.col(path)), F.lit(wanted)))


def listed(lines: DataFrame, line: str = "value") -> DataFrame:
    """(path, name, is_local) of a list file's lines; blank ones and those after # are left out."""
    text = strip(F.col(line))
    path = strip(F.element_at(F.split(text, ","), 1))
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
    rows = lines.where((text != "") & ~F.startswith(text, F.lit("#")))
    return rows.select(path.alias("path"), stem.alias("name"), (~path.rlike("^https?://")).alias("is_local"))


_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"^(.*?)\bstream\r?\n(.*?)\r?\n?endstream", re.S)
_REFERENCE = re.compile(rb"(\d+)\s+\d+\s+R")
_TOKEN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/\[\]<>()]+|-?\d*\.?\d+|T\*|[A-Za-z'\"]+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
_SPACE_FROM = -200  # a shift in an array of strings, in thousandths of the font's size, from which it stands for a space


def _literal(raw: bytes) -> bytes:
    return re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else _ESCAPES.get(m[1], m[1]), raw[1:-1], flags=re.S)


def _inflated(raw: bytes) -> bytes | None:
    """A stream's data, inflated where its dictionary says so; None where that fails."""
    m = _STREAM.match(raw)
    if not m:
        return None
    if b"FlateDecode" not in m[1]:
        return m[2]
    try:
        return zlib.decompressobj().decompress(m[2])
    except zlib.error:
        return None


class Document:
    """A PDF's objects, its pages in the order of the page tree, and their fonts."""

    def __init__(self, content: bytes):
        self.objects: dict[int, bytes] = {int(m[1]): m[2] for m in _OBJECT.finditer(content)}  # later ones replace earlier ones
        for raw in list(self.objects.values()):
            if b"/ObjStm" in raw[:400] and (data := _inflated(raw)) is not None:
                first = int(re.search(rb"/First\s+(\d+)", raw)[1])
                pairs = [int(x) for x in data[:first].split()]
                starts = pairs[1::2] + [len(data) - first]
                for number, begin, end in zip(pairs[::2], starts, starts[1:]):
                    self.objects.setdefault(number, data[first + begin : first + end])
        roots = [self.objects.get(int(m[1]), b"") for m in re.finditer(rb"/Root\s+(\d+)\s+\d+\s+R", content)]
        roots += [o for o in self.objects.values() if re.search(rb"/Type\s*/Catalog\b", o)]
        tree = next((m for o in reversed(roots) if (m := re.search(rb"/Pages\s+(\d+)", o))), None)
        self.pages: list[tuple[bytes, bytes]] = []
        self._maps: dict[int, tuple[int, dict[int, str]] | None] = {}
        if tree:
            self._walk(int(tree[1]), b"", set())

    def _walk(self, number: int, fonts: bytes, seen: set[int]) -> None:
        """Pages below a node of the tree; fonts are inherited."""
        node = self.objects.get(number)
        if node is None or number in seen:
            return
        seen.add(number)
        fonts = self._fonts(node) or fonts
        kids = re.search(rb"/Kids\s*\[(.*?)\]", node, re.S)
        if kids:
            for m in _REFERENCE.finditer(kids[1]):
                self._walk(int(m[1]), fonts, seen)
        else:
            self.pages.append((node, fonts))

    def _fonts(self, node: bytes) -> bytes:
        at = re.search(rb"/Resources\s+(\d+)\s+\d+\s+R", node)
        resources = self.objects.get(int(at[1]), b"") if at else node
        if at := re.search(rb"/Font\s+(\d+)\s+\d+\s+R", resources):
            return self.objects.get(int(at[1]), b"")
        at = re.search(rb"/Font\s*<<(.*?)>>", resources, re.S)
        return at[1] if at else b""

    def _map(self, number: int) -> tuple[int, dict[int, str]] | None:
        """(bytes a code, code -> text) of a font with a map to Unicode."""
        if number not in self._maps:
            at = re.search(rb"/ToUnicode\s+(\d+)", self.objects.get(number, b""))
            data = _inflated(self.objects.get(int(at[1]), b"")) if at else None
            self._maps[number] = self._read_map(data) if data else None
        return self._maps[number]

    @staticmethod
    def _read_map(data: bytes) -> tuple[int, dict[int, str]]:
        text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
        width, table = 1, {}
        if at := re.search(rb"begincodespacerange\s*<([0-9A-Fa-f]+)>", data):
            width = len(at[1]) // 2
        for part in re.findall(rb"beginbfchar(.*?)endbfchar", data, re.S):
            for code, to in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", part):
                table[int(code, 16)] = text(to)
        for part in re.findall(rb"beginbfrange(.*?)endbfrange", data, re.S):
            for low, high, to in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*(<[0-9A-Fa-f]+>|\[.*?\])", part, re.S):
                first, last = int(low, 16), int(high, 16)
                if to[:1] == b"[":
                    table.update(zip(range(first, last + 1), map(text, re.findall(rb"<([0-9A-Fa-f]+)>", to))))
                else:
                    begin = text(to[1:-1])
                    table.update((code, begin[:-1] + chr(ord(begin[-1]) + code - first)) for code in range(first, min(last, first + 0xFFFF) + 1))
        return width, table

    def text(self, page: tuple[bytes, bytes]) -> str:
        """A page's text: the strings it shows, a line for each move to another one."""
        node, fonts = page
        contents = re.search(rb"/Contents\s*(\[.*?\]|\d+\s+\d+\s+R)", node, re.S)
        numbers = [int(m[1]) for m in _REFERENCE.finditer(contents[1])] if contents else []
        data = b"\n".join(d for n in numbers if (d := _inflated(self.objects.get(n, b""))) is not None)
        known = {m[1]: int(m[2]) for m in re.finditer(rb"(/[^\s/<>\[\]]+)\s+(\d+)\s+\d+\s+R", fonts)}
        return shown(data, lambda name: self._map(known[name]) if name in known else None)


def shown(data: bytes, font: Callable[[bytes], tuple[int, dict[int, str]] | None] = lambda name: None) -> str:
    """The text that a content stream shows."""
    parts: list[str] = []
    operands: list[bytes] = []
    table = None

    def decoded(raw: bytes) -> str:
        data = _literal(raw) if raw[:1] == b"(" else bytes.fromhex((h := re.sub(rb"\s", b"", raw[1:-1]).decode()) + "0" * (len(h) % 2))
        if table is None:
            return data.decode("cp1252", "replace")
        width, signs = table
        return "".join(signs.get(int.from_bytes(data[i : i + width], "big"), "") for i in range(0, len(data), width))

    for m in _TOKEN.finditer(data):
        token = m[0]
        if token[:1] in b"(</[]-.0123456789":
            operands.append(token)
            continue
        if token == b"Tf":
            names = [o for o in operands if o[:1] == b"/"]
            table = font(names[-1]) if names else None
        elif token in (b"Tj", b"TJ", b"'", b'"'):
            if token in (b"'", b'"'):
                parts.append("\n")
            for o in operands:
                if o[:1] in b"(<":
                    parts.append(decoded(o))
                elif token == b"TJ" and o[:1] in b"-.0123456789" and float(o) <= _SPACE_FROM:
                    parts.append(" ")
        elif token in (b"T*", b"TD", b"ET") or (token in (b"Td", b"Tm") and (token == b"Tm" or not operands or float(operands[-1]) != 0)):
            parts.append("\n")
        operands.clear()
    return re.sub(r"\n{2,}", "\n", "".join(parts)).strip("\n")


def pdf_pages(content: bytes, most: int = 0) -> tuple[int, list[str]]:
    """(pages in all, text of the first ``most`` pages; all for 0) of a PDF, by its page tree.

    Fonts are read by their maps to Unicode, others as Windows Latin.  A file without a page tree gives one page for each
    stream that shows text.  Encrypted files and pictures of text need another parser, which can be given to ``extract``.
    """
    if not content.startswith(b"%PDF"):
        raise ValueError("no PDF")
    document = Document(content)
    if document.pages:
        return len(document.pages), [document.text(p) for p in document.pages[: most or None]]
    total, pages = len(re.findall(rb"/Type\s*/Page(?![a-zA-Z])", content)), []
    for m in re.finditer(rb"<<[^>]*(?:>(?!>)[^>]*)*>>\s*stream\r?\n.*?\r?\nendstream", content, re.S):
        if most > 0 and len(pages) >= min(most, total or most):
            break
        data = _inflated(m[0])
        if data and b"BT" in data and re.search(rb"Tj|TJ", data):
            pages.append(shown(data))
    return total or len(pages), pages


def extract(df: DataFrame, max_pages: int = 0, parser: Callable[[bytes, int], tuple[int, list[str]]] = pdf_pages, key: str = "doc_id") -> DataFrame:
    """(key, pages_total, pages_read, pages, status, error); a document that can't be parsed has status error and null pages.

    The page limit goes to the parser, so pages beyond it aren't parsed; the content goes no further than here.  Rows
    without a column ``content`` are read by their ``path``, one file at a time.
    """
    column = "content" if "content" in df.columns else "path"
    schema = f"{key} string, pages_total int, pages_read int, pages array<string>, status string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, content in zip(batch[key], batch[column]):
                try:
                    total, pages = parser(read_file(content) if isinstance(content, str) else bytes(content), max_pages)
                    rows.append((doc, total, len(pages), pages, "ok", None))
                except MemoryError as e:
                    rows.append((doc, None, None, None, "oom", str(e)))
                except Exception as e:  # noqa: BLE001 - one bad document must not end the job
                    rows.append((doc, None, None, None, "error", f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[key, "pages_total", "pages_read", "pages", "status", "error"])

    return df.select(key, column).mapInPandas(run, schema)
