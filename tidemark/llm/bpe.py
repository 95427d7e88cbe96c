"""Byte-level BPE encoding and decoding with recursive DuckDB queries inside Spark tasks.

Spark deals out the documents; inside a task only *distinct* pieces of text are tokenised.  A piece's pre-tokens (matches
of the tokenizer's pattern) become token-position rows ``(word, pos, id)`` of an in-process DuckDB table.  A recursive
query joins neighbouring positions to the merge table (every split of a token into two tokens, ranked by the merged one)
and contracts each word's leftmost pair of minimum rank, until no pair of any word is in the table.  Decoding joins the
ids back to the vocabulary and concatenates their bytes with an ordered aggregate.

A recursive query keeps the rows of all its steps, so a word above ``LONG_WORD`` bytes is contracted by repeated statements
that keep one state.  One such step contracts several pairs of the minimum rank from left to right, up to the first whose
new neighbours form a pair of that rank or below; up to there one contraction at a time does the same.

Defined results: a null or empty text has no tokens; any other text, however long, is encoded whole.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_state, text_slices

#: A recursive query keeps the rows of all its steps, so words above this length are contracted step by step instead.
LONG_WORD = 400
#: Bytes of distinct words in one recursive query, and of texts whose new words are contracted together.
QUERY_BYTES = 1 << 19
TEXT_BYTES = 1 << 22
#: Pieces that a generation of a worker's cache takes, and the characters of a piece up to which it is kept.  There are two
#: generations: a full one becomes the older one, whose pieces come back when they are met.
CACHE_PIECES = 250_000
CACHE_CHARS = 100


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_table(ranks: dict[bytes, int]) -> list[tuple[int, int, int]]:
    """(left id, right id, merged id) for every split of a token into two tokens; an id is a rank."""
    rows = []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                rows.append((left, right, rank))
    return rows


# Contract the leftmost pair of minimum rank of every word that has one.  Positions keep their first numbers and know the
# next one's and its id, and carry the code of the pair that they begin, rank * 2^20 + pos, so the minimum is the pair to
# contract and the merge table is asked for the two new pairs of a word only.
_RECURSIVE = """
    WITH RECURSIVE state(word, pos, nxt, id, next_id, code, step) AS (
        SELECT s.word, s.pos, s.pos + 1, s.id, s.next_id, CAST(m.merged AS BIGINT) * 1048576 + s.pos, 0
        FROM start s LEFT JOIN merges m ON m.lft = s.id AND m.rgt = s.next_id
        UNION ALL
        (
            WITH best AS (
                SELECT word, min(code) AS code, arg_min(nxt, code) AS gone FROM state GROUP BY word HAVING min(code) IS NOT NULL
            ), hit AS (
                SELECT b.word, CAST(b.code % 1048576 AS INTEGER) AS pos, CAST(b.code // 1048576 AS INTEGER) AS merged, b.gone, g.nxt, g.next_id
                FROM best b JOIN state g ON g.word = b.word AND g.pos = b.gone
            ), after AS (
                SELECT s.word, s.pos,
                       CASE WHEN s.pos = h.pos THEN h.nxt ELSE s.nxt END AS nxt,
                       CASE WHEN s.pos = h.pos THEN h.merged ELSE s.id END AS id,
                       CASE WHEN s.pos = h.pos THEN h.next_id WHEN s.nxt = h.pos THEN h.merged ELSE s.next_id END AS next_id,
                       s.code, s.step + 1 AS step, s.pos = h.pos OR s.nxt = h.pos AS changed
                FROM state s JOIN hit h ON h.word = s.word
                WHERE s.pos <> h.gone
            )
            SELECT a.word, a.pos, a.nxt, a.id, a.next_id, CASE WHEN changed THEN CAST(m.merged AS BIGINT) * 1048576 + a.pos ELSE a.code END, a.step
            FROM after a LEFT JOIN merges m ON m.lft = CASE WHEN changed THEN a.id END AND m.rgt = a.next_id
        )
    )
    SELECT s.word, s.pos, s.id
    FROM state s JOIN (SELECT word, max(step) AS step FROM state WHERE pos = 0 GROUP BY word) e
        ON e.word = s.word AND e.step = s.step
"""

# Pairs of minimum rank of one long word, every other one of an overlapping run, up to the first that gives a new pair of
# that rank or below.
_RUNS = """
    WITH pairs AS (
        SELECT p.*, m.merged, min(m.merged) OVER () AS least
        FROM (
            SELECT pos, id, row_number() OVER o AS place, lag(id) OVER o AS before, lead(id) OVER o AS next_id,
                   lead(id, 2) OVER o AS after
            FROM state WINDOW o AS (ORDER BY pos)
        ) p LEFT JOIN merges m ON m.lft = p.id AND m.rgt = p.next_id
    ), hits AS (
        SELECT *, row_number() OVER (PARTITION BY run ORDER BY place) % 2 = 1 AS chosen
        FROM (SELECT *, place - row_number() OVER (ORDER BY place) AS run FROM pairs WHERE merged = least)
    ), picked AS (
        SELECT h.*, coalesce(lag(h.place) OVER (ORDER BY h.place) = h.place - 2, false) AS beside FROM hits h WHERE h.chosen
    ), last AS (
        SELECT coalesce(min(k.place), 9223372036854775807) AS place
        FROM picked k
        LEFT JOIN merges l ON l.lft = CASE WHEN k.beside THEN k.least ELSE k.before END AND l.rgt = k.least
        LEFT JOIN merges r ON r.lft = k.least AND r.rgt = k.after
        WHERE l.merged <= k.least OR r.merged <= k.least
    )
    SELECT p.pos, CASE WHEN k.place IS NULL THEN p.id ELSE p.least END AS id
    FROM pairs p
    LEFT JOIN (SELECT place FROM picked WHERE place <= (SELECT place FROM last)) k ON k.place = p.place
    LEFT JOIN (SELECT place FROM picked WHERE place <= (SELECT place FROM last)) e ON e.place = p.place - 1
    WHERE e.place IS NULL
"""

_DECODE = """
    SELECT t.word, string_agg(v.hex, '' ORDER BY t.pos) AS hex, string_agg(v.digits, ',' ORDER BY t.pos) AS ids
    FROM tokens t JOIN vocabulary v ON v.id = t.id GROUP BY t.word
"""


def _fixed(values, kind) -> pa.Array:
    return pa.array(np.ascontiguousarray(values), kind)


class Codec:
    """One DuckDB connection with the merge table and the vocabulary of a rank file, and the pieces met so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": "400MB", "temp_directory": ""})
        merges = np.array(merge_table(ranks), np.int32)
        self._table("merges", lft=_fixed(merges[:, 0], pa.int32()), rgt=_fixed(merges[:, 1], pa.int32()), merged=_fixed(merges[:, 2], pa.int32()))
        self._table("vocabulary", id=pa.array(list(ranks.values()), pa.int32()), hex=pa.array([t.hex() for t in ranks]), digits=pa.array([str(r) for r in ranks.values()]))
        self.pieces: dict[str, tuple[str, bytes]] = {}
        self.older: dict[str, tuple[str, bytes]] = {}

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.db.register("fresh", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM fresh")
        self.db.unregister("fresh")

    def _start(self, words: list[bytes]) -> None:
        sizes = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes)
        pos = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        next_id = np.append(ids[1:], -1)
        next_id[ends - 1] = -1
        self._table("start", word=_fixed(word, pa.int32()), pos=_fixed(pos, pa.int32()), id=_fixed(ids, pa.int32()), next_id=_fixed(next_id, pa.int32()))

    def _contract_long(self) -> None:
        """The word in ``start``, contracted by repeated statements; holds one state at a time."""
        self.db.execute("CREATE OR REPLACE TEMP TABLE state AS SELECT pos, id FROM start")
        before = None
        while before != (size := self.db.execute("SELECT count(*) FROM state").fetchall()[0][0]):
            self.db.execute(f"CREATE OR REPLACE TEMP TABLE after AS {_RUNS}")
            self.db.execute("CREATE OR REPLACE TEMP TABLE state AS SELECT * FROM after")
            before = size
        self.db.execute("CREATE OR REPLACE TEMP TABLE tokens AS SELECT 0 AS word, pos, id FROM state")

    def encode_words(self, words: list[bytes]) -> list[tuple[str, bytes]]:
        """(ids joined by commas, decoded bytes) of each pre-token.  One that is itself a token has that id."""
        out: list[tuple[str, bytes]] = [("", b"")] * len(words)
        at = 0
        while at < len(words):
            chosen, size = [at], len(words[at])
            at += 1
            if words[chosen[0]] in self.ranks:
                ids = pa.array([self.ranks[words[chosen[0]]]], pa.int32())
                self._table("tokens", word=pa.array([0], pa.int32()), pos=pa.array([0], pa.int32()), id=ids)
            elif size > LONG_WORD:
                self._start([words[chosen[0]]])
                self._contract_long()
            else:
                while at < len(words) and len(words[at]) <= LONG_WORD and size < QUERY_BYTES:
                    chosen.append(at)
                    size += len(words[at])
                    at += 1
                self._start([words[i] for i in chosen])
                whole = [(k, self.ranks[words[i]]) for k, i in enumerate(chosen) if words[i] in self.ranks]
                self._table("whole", word=pa.array([k for k, _ in whole], pa.int32()), id=pa.array([i for _, i in whole], pa.int32()))
                self.db.execute("DELETE FROM start WHERE word IN (SELECT word FROM whole)")
                self.db.execute(f"CREATE OR REPLACE TEMP TABLE tokens AS {_RECURSIVE}")
                self.db.execute("INSERT INTO tokens SELECT word, 0, id FROM whole")
            for word, hexed, ids in self.db.execute(_DECODE).fetchall():
                out[chosen[word]] = (ids, bytes.fromhex(hexed))
        return out

    def known(self, piece: str) -> tuple[str, bytes] | None:
        got = self.pieces.get(piece)
        if got is None and (got := self.older.get(piece)) is not None:
            self.pieces[piece] = got
        return got

    def learn(self, pieces: list[str]) -> dict[str, tuple[str, bytes]]:
        """Encode pieces that are not known yet; a pre-token is a piece as well, and new ones are contracted together."""
        split = [self.pattern.findall(p) for p in pieces]
        met = {w: self.known(w) for w in dict.fromkeys(itertools.chain.from_iterable(split))}
        words = [w for w, got in met.items() if got is None]
        met.update(zip(words, self.encode_words([w.encode() for w in words]), strict=True))
        for piece, ws in zip(pieces, split, strict=True):
            if len(ws) > 1:
                parts = [met[w] for w in ws]
                met[piece] = (",".join([p[0] for p in parts]), b"".join([p[1] for p in parts]))
        self.pieces.update((w, got) for w, got in met.items() if len(w) <= CACHE_CHARS)
        return met

    def encode(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """(ids joined by commas, decoded bytes) of each text."""
        if len(self.pieces) > CACHE_PIECES:
            self.older, self.pieces = self.pieces, {}
        cut = [pieces_of(t) for t in texts]
        held = [list(map(self.pieces.get, pieces)) for pieces in cut]
        new = [k for k, got in enumerate(held) if None in got]
        fresh = dict.fromkeys(p for k in new for p, g in zip(cut[k], held[k], strict=True) if g is None)
        found = {p: got for p in fresh if (got := self.known(p)) is not None}
        found.update(self.learn([p for p in fresh if p not in found]))
        for k in new:
            held[k] = [g or found[p] for p, g in zip(cut[k], held[k], strict=True)]
        for got in held:
            yield ",".join([g[0] for g in got]), b"".join([g[1] for g in got])


def pieces_of(text: str) -> list[str]:
    """Cut a text before every single space between two other characters; the pattern never matches across such a place."""
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or "  " in text:
        return _BETWEEN.split(text)
    for space in _OTHER_SPACES:
        if space in text and (space + " " in text or " " + space in text):
            return _BETWEEN.split(text)
    first, *rest = text.split(" ")
    return [first, *map(" ".__add__, rest)]


_BETWEEN = re.compile(r"(?<=\S)(?=\x20\S)")
_OTHER_SPACES = [c for c in map(chr, range(0x10000)) if c.isspace() and c != " "]


def held_codec(key: str, pattern: str, ranks: dict[bytes, int]) -> Codec:
    """A worker's codec by the digest of its rank table, made once, until the worker runs another operator that keeps a state."""
    return held_state(("bpe", key, pattern), lambda: Codec(ranks, pattern))


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``ids_sha256`` is the lower-case hex of the decimal ids joined by commas, ``decoded_sha256`` that of the bytes that the
    ids decode to.  The rank table (about 1 MB, a fixed file) is broadcast.  There is no shuffle.
    """
    ranks = read_ranks(rank_path)
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held_codec(key, pattern, shared.value)
        gc.freeze()  # the tables and pieces live as long as the worker; collections need not visit them
        for batch in batches:
            for part in text_slices(batch, "text", TEXT_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                counts, ids, decoded = [], [], []
                for joined, raw in codec.encode(texts):
                    counts.append(joined.count(",") + 1 if joined else 0)
                    ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    decoded.append(hashlib.sha256(raw).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
