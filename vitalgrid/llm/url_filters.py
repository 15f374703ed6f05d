"""URL filters by a bit-parallel wildcard automaton.

Glob rules over ``.host SEP path`` are laid out side by side in 64-bit words: one bit per pattern
position, a mask per byte value, and a self-loop mask for ``*``.  One Shift-And step per byte then
advances every rule for every URL of a batch at once; URLs are taken longest first so that finished
ones leave the active block.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and is
blocked by the method (there is nothing to fetch); repeated rows give repeated results; further
columns are not read.  The rule list is a parameter and its size bounds what each task holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands between host and path; no UTF-8 text contains this byte.
SEP = b"\xff"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains and a path prefix (``host/path``).

    ``*`` and ``?`` in the name are wildcards as in a ``Glob``; a rule cannot name them literally.
    """

    verdict: str
    name: str

    def glob(self) -> bytes:
        host, slash, path = self.name.partition("/")
        return b"*." + host.encode() + SEP + (slash + path).encode() + b"*"


@dataclass(frozen=True)
class Glob:
    """``verdict`` for a glob over the canonical form; decides only where no ``Rule`` fits."""

    verdict: str
    pattern: str

    def glob(self) -> bytes:
        return self.pattern.encode().replace(b"|", SEP)


#: The rules of the query.
RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)
#: The method's own rules: ``|`` is the boundary of host and path, ``*`` any run, ``?`` any byte.
GLOBS = (
    Glob("block", ".*spam*|*"),
    Glob("block", "*.ads.*|*"),
    Glob("block", "*|*/ads/*"),
    Glob("block", "*|*.exe"),
    Glob("block", "|*"),
    Glob("block", ".|*"),
)


class ShiftAnd:
    """All patterns in one multiword automaton."""

    def __init__(self, patterns: Sequence[bytes]):
        spans = []
        bits = 0
        for p in patterns:
            spans.append((bits, p))
            bits += len(p.replace(b"*", b"")) + 1
        words = max(1, -(-bits // 64))
        self.start = np.zeros(words, np.uint64)
        self.loop = np.zeros(words, np.uint64)
        self.mask = np.zeros((256, words), np.uint64)
        self.final = []
        for first, p in spans:
            at = first
            self._set(self.start, at)
            for c in p:
                if c == ord("*"):
                    self._set(self.loop, at)
                    continue
                at += 1
                for byte in range(256) if c == ord("?") else (c,):
                    self._set(self.mask[byte], at)
            self.final.append((at // 64, np.uint64(at % 64)))

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """Boolean matrix: text by pattern."""
        n = len(texts)
        out = np.zeros((n, len(self.final)), bool)
        if not n:
            return out
        length = np.fromiter(map(len, texts), np.int64, n)
        order = np.argsort(-length, kind="stable")
        length = length[order]
        flat = np.frombuffer(b"".join(texts) or b"\0", np.uint8)
        offset = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, n))))[:-1][order]
        state = np.repeat(self.start[None, :], n, axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for j in range(int(length[0])):
            active = int(np.searchsorted(-length, -j, side="left"))
            d = state[:active]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            state[:active] = (moved & self.mask[flat[offset[:active] + j]]) | (d & self.loop)
        for k, (word, bit) in enumerate(self.final):
            out[order, k] = (state[:, word] >> bit) & one == one
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(whole, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(whole, pattern, 2)


def filter_urls(
    pages: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    globs: Sequence[Glob] = GLOBS,
    default: str = "allow",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` for every row of ``pages``.

    The longest fitting rule wins, else the longest fitting glob, else ``default``.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name)) + sorted(globs, key=lambda g: (-len(g.pattern), g.pattern))
    n_rules = len(rules)
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(page_id), host.alias("host"), path.alias("path"))
    names = [r.name if isinstance(r, Rule) else None for r in ranked] + [None]
    shown = [r.pattern if isinstance(r, Glob) else None for r in ranked] + [None]
    verdicts = [r.verdict for r in ranked] + [default]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ShiftAnd([r.glob() for r in ranked])
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            keys = [b"." * bool(h) + h.encode() + SEP + p.encode() for h, p in zip(hosts, paths, strict=True)]
            hit = automaton.match(keys)
            first = np.where(hit.any(axis=1), hit.argmax(axis=1), len(ranked)) if hit.size else np.full(len(keys), len(ranked))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([names[i] for i in first], pa.string()),
                    pa.array([verdicts[i] for i in first], pa.string()),
                    pa.array([shown[i] for i in first], pa.string()),
                ],
                names=[*batch.schema.names, "rule", "verdict", "pattern"],
            )

    assert all(isinstance(r, Rule) for r in ranked[:n_rules])
    id_type = pages.schema[page_id].dataType.simpleString()
    return parts.mapInArrow(
        run, f"`{page_id}` {id_type}, host string, path string, rule string, verdict string, pattern string"
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP10_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS u FROM pages
), s AS (
  SELECT page_id,
         translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(u, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM p
), r(verdict, rh, rp) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), hit AS (
  SELECT page_id, host, path, max_by(rh || rp, length(rh || rp)) AS rule, max_by(verdict, length(rh || rp)) AS v
  FROM s JOIN r ON (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY ALL
), g(verdict, pat, re) AS (
  VALUES ('block', '.*spam*|*', '^\..*spam.*\|'), ('block', '*.ads.*|*', '\.ads\..*\|'),
         ('block', '*|*/ads/*', '\|.*/ads/'), ('block', '*|*.exe', '\|.*\.exe$'),
         ('block', '|*', '^\|'), ('block', '.|*', '^\.\|')
), gh AS (
  SELECT page_id, max_by(pat, (length(pat), pat)) AS pattern
  FROM s JOIN g ON regexp_matches((CASE WHEN host = '' THEN '' ELSE '.' END) || host || '|' || replace(path, '|', ' '), re)
  GROUP BY ALL
)
SELECT s.page_id, s.host, s.path, hit.rule,
       coalesce(hit.v, CASE WHEN gh.pattern IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN hit.rule IS NULL THEN gh.pattern END AS pattern
FROM s LEFT JOIN hit USING (page_id) LEFT JOIN gh USING (page_id)
"""
