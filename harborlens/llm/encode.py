"""Token ids of every text under a public byte-level BPE vocabulary, by recursive DuckDB queries per partition.

A worker keeps the ids of the words it has met. The new words of a batch go, as one row per word with its byte tokens,
through a recursive query: token-position rows join the merge table, each word's pair of least rank is contracted at its
leftmost places, and words drop out once no pair is in the table (the fixpoint). Decoding joins ids with the vocabulary
and puts the bytes together by an ordered aggregation.

A word of more than LONG bytes (a base64 body, a text without blanks) is contracted in parts, whose seams are then mended. A
sequence of tokens is the encoding of its bytes exactly if each two neighbours are the encoding of theirs; so a seam
whose neighbours pass that test stands, and around any other the tokens are contracted anew, in windows that double
until all seams stand.

Defined cases
    * null and empty texts have an empty list of ids; strings that look like special tokens are plain text.
    * whole texts are encoded, whatever their length; repeated texts give the same ids.
    * ids that are in no vocabulary decode to nothing; bytes that are no UTF-8 decode to U+FFFD, as the vocabulary's own tools do.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property
from itertools import chain, pairwise

import regex
from pyspark.sql import DataFrame

#: Fixed value: the published split of text into words before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where the vocabulary file lies unless told otherwise.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Words of one query, by count and by bytes, and words a worker remembers; bounds of memory that change no result.
CHUNK_WORDS, CHUNK_BYTES, REMEMBERED = 20_000, 1 << 20, 400_000
#: Bytes from which on a word is cut, bytes of a part, and tokens on each side of a seam that are contracted anew first.
LONG, PART, WINDOW = 256, 32, 4

CONTRACT = """
with recursive bpe(w, toks) using key (w) as (
    select w, toks from fresh
    union
    (with pos as (select w, unnest(toks) as t, generate_subscripts(toks, 1) as p from bpe),
    pair as (select w, p, t, lead(t) over (partition by w order by p) as nxt from pos),
    ranked as (select pair.w, p, t, m.merged, m.rnk, min(m.rnk) over (partition by pair.w) as best from pair left join merges m on m.l = pair.t and m.r = pair.nxt),
    hit as (select w, p, t, merged, coalesce(rnk = best, false) as h from ranked where best is not null),
    run as (select *, coalesce(max(case when not h then p end) over (partition by w order by p), 0) as off from hit),
    take as (select w, p, t, merged, h and (p - off) % 2 = 1 as k from run),
    done as (select w, p, case when k then merged else t end as t, coalesce(lag(k) over (partition by w order by p), false) as gone from take)
    select w, list(t order by p) filter (where not gone) as toks from done group by w)
)
select w, toks from bpe order by w
"""

DECODE = """
with pos as (select doc, unnest(ids) as id, generate_subscripts(ids, 1) as p from batch)
select doc, string_agg(hex(v.bytes), '' order by p) as text from pos join vocabulary v using (id) group by doc
"""


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if printable, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabulary:
    """Token bytes by id, and merges (left id, right id, rank, merged id). About 50,000 of each, whatever the data."""

    name: str
    tokens: list[tuple[int, bytes]]
    merges: list[tuple[int, int, int, int]]

    @staticmethod
    def load(path: str = VOCABULARY) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, ids = _byte_letters(), model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        return Vocabulary(
            path,
            [(i, bytes(letters[c] for c in t)) for t, i in ids.items()],
            [(ids[a], ids[b], rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)],
        )


class Encoder:
    """One worker's database and remembered words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, list[int]] = {}
        self.seams: dict[tuple[int, int], bool] = {}

    @cached_property
    def byte_ids(self) -> list[int]:
        single = {t[0]: i for i, t in self.vocabulary.tokens if len(t) == 1}
        return [single[b] for b in range(256)]

    @cached_property
    def db(self):
        import duckdb
        import pyarrow as pa

        db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        left, right, rank, merged = (pa.array(x, pa.int32()) for x in zip(*self.vocabulary.merges, strict=True))
        merges = pa.table({"l": left, "r": right, "rnk": rank, "merged": merged})
        tokens = pa.table({"id": pa.array([i for i, _ in self.vocabulary.tokens], pa.int32()), "bytes": pa.array([t for _, t in self.vocabulary.tokens], pa.binary())})
        db.register("merge_rows", merges)
        db.register("token_rows", tokens)
        db.execute("create table merges as select * from merge_rows")
        db.execute("create table vocabulary as select * from token_rows")
        return db

    @cached_property
    def token_bytes(self) -> dict[int, bytes]:
        return dict(self.vocabulary.tokens)

    def contract(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word, by the recursive query, in chunks of bounded size (a word above it stands alone)."""
        import pyarrow as pa

        out, start = [], 0
        while start < len(words):
            end, size = start, 0
            while end < len(words) and end - start < CHUNK_WORDS and (size + len(words[end]) <= CHUNK_BYTES or end == start):
                size += len(words[end])
                end += 1
            tokens = [[self.byte_ids[b] for b in w] for w in words[start:end]]
            self.db.register("fresh", pa.table({"w": pa.array(range(len(tokens)), pa.int32()), "toks": pa.array(tokens, pa.list_(pa.int32()))}))
            out += [ids for _, ids in self.db.execute(CONTRACT).fetchall()]
            start = end
        return out

    def _stand(self, pairs: set[tuple[int, int]]) -> None:
        """Learns which pairs of neighbours are the encoding of their bytes."""
        if len(self.seams) > REMEMBERED:
            self.seams.clear()
        new = [p for p in pairs if p not in self.seams]
        for pair, ids in zip(new, self.contract([self.token_bytes[a] + self.token_bytes[b] for a, b in new]), strict=True):
            self.seams[pair] = ids == list(pair)

    def long(self, words: list[bytes]) -> list[list[int]]:
        """The ids of words of any length; all words' parts, seams and windows of a round go through one query each."""
        parts = [[w[i : i + PART] for i in range(0, len(w), PART)] for w in words]
        distinct = list(dict.fromkeys(p for of in parts for p in of))
        ids_of = dict(zip(distinct, self.contract(distinct), strict=True))
        ids, seams = [], []
        for of in parts:
            tokens, places = [], []
            for part in of:
                places.append(len(tokens))
                tokens += ids_of[part]
            ids.append(tokens)
            seams.append(places[1:])
        width, open_ = WINDOW, range(len(words))
        while open_:
            self._stand({(ids[w][s - 1], ids[w][s]) for w in open_ for s in seams[w]})
            windows: list[tuple[int, int, int]] = []
            for w in open_:
                for s in seams[w]:
                    if self.seams[ids[w][s - 1], ids[w][s]]:
                        continue
                    low, high = max(0, s - width), min(len(ids[w]), s + width)
                    if windows and windows[-1][0] == w and low <= windows[-1][2]:
                        low = windows.pop()[1]
                    windows.append((w, low, high))
            anew = self.contract([b"".join(self.token_bytes[i] for i in ids[w][low:high]) for w, low, high in windows])
            mended: dict[int, list] = {}
            for window, tokens in zip(windows, anew, strict=True):
                mended.setdefault(window[0], []).append((*window[1:], tokens))
            for w, changes in mended.items():
                out: list[int] = []
                places, at = [], 0
                for low, high, tokens in changes:
                    out += ids[w][at:low]
                    places += [len(out), len(out) + len(tokens)]
                    out += tokens
                    at = high
                ids[w] = out + ids[w][at:]
                seams[w] = [s for s in dict.fromkeys(places) if 0 < s < len(ids[w])]
            width, open_ = width * 2, list(mended)
        return ids

    def learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        for some, ids in ((lambda n: n <= LONG, self.contract), (lambda n: n > LONG, self.long)):
            own = [(w, b) for w, b in zip(words, raw, strict=True) if some(len(b))]
            self.known.update(zip([w for w, _ in own], ids([b for _, b in own]), strict=True))

    def flat(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """The ids of all texts one after the other, and where each text's begin and the last one's end."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        split = [self.split(t) if t else [] for t in texts]
        known = self.known
        new = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in known]
        self.learn(new)
        ids: list[int] = []
        ends = [0]
        for words in split:
            ids.extend(chain.from_iterable(map(known.__getitem__, words)))
            ends.append(len(ids))
        for w in new:
            if len(w) > LONG:  # hardly met again, and large
                del known[w]
        return ids, ends

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        ids, ends = self.flat(texts)
        return [ids[a:b] for a, b in pairwise(ends)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        import pyarrow as pa

        self.db.register("batch", pa.table({"doc": pa.array(range(len(ids)), pa.int32()), "ids": pa.array(ids, pa.list_(pa.int32()))}))
        found = dict(self.db.execute(DECODE).fetchall())
        return [bytes.fromhex(found.get(i, "")).decode("utf-8", "replace") for i in range(len(ids))]


#: The encoder of this worker process: tasks that follow each other share its tables and remembered words.
_here: dict[str, Encoder] = {}


def worker_encoder(vocabulary: Vocabulary) -> Encoder:
    if vocabulary.name not in _here:
        _here.clear()
        _here[vocabulary.name] = Encoder(vocabulary)
    return _here[vocabulary.name]


def _mapped(rows: DataFrame, columns: list[str], schema: str, work, vocabulary: Vocabulary, texts: bool = True) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)  # of fixed size

    def run(batches):
        from harborlens.llm.batches import slices
        from harborlens.llm.encode import worker_encoder

        encoder = worker_encoder(shared.value)
        for batch in batches:
            for part in slices(batch, 1) if texts else [batch]:
                yield work(encoder, part)

    return rows.select(*columns).mapInArrow(run, schema)


def encode(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: Vocabulary | None = None) -> DataFrame:
    """key, ids. Texts are encoded where they are read; nothing is shuffled."""

    def work(encoder, batch):
        import pyarrow as pa

        ids, ends = encoder.flat(batch.column(1).to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int64()))
        return pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

    return _mapped(documents, [key, text], f"{key} bigint, ids array<bigint>", work, vocabulary or Vocabulary.load())


def token_counts(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: Vocabulary | None = None) -> DataFrame:
    """key, n_tokens."""

    def work(encoder, batch):
        import pyarrow as pa

        _, ends = encoder.flat(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([b - a for a, b in pairwise(ends)], pa.int64())], names=[key, "n_tokens"])

    return _mapped(documents, [key, text], f"{key} bigint, n_tokens bigint", work, vocabulary or Vocabulary.load())


def decode(encoded: DataFrame, key: str = "doc_id", vocabulary: Vocabulary | None = None) -> DataFrame:
    """key, text: the inverse of encode; empty lists give the empty text."""

    def work(encoder, batch):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(encoder.decode(batch.column(1).to_pylist()))], names=[key, "text"])

    return _mapped(encoded, [key, "ids"], f"{key} bigint, text string", work, vocabulary or Vocabulary.load(), texts=False)
