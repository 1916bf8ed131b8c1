"""Operator 8, SentencePiece encoding and decoding by a distinct-chunk table.

A text's blanks become whitespace marks.  No piece of the model holds a mark
after another character (checked when the model is loaded), so merges never
cross the start of a mark run; each distinct marked word is segmented once per
worker table and its ids are joined back by position.

The table is per task rather than a global join: a join would shuffle every word
of the corpus with its position, several times the text, to save at most a few
repeated segmentations of each word.

Edge cases: a null or empty text has the end id only and decodes to the empty
text; blanks anywhere are kept; U+2581 in a text counts as a blank, as in the
library; repeated rows give repeated rows; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import DataFrame

from pairforge.llm.chunks import ChunkTable, split_marked
from pairforge.llm.common import text_batches, worker_cache


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Codec:
    """Encoder and decoder of one model; results equal the library's encode and decode."""

    def __init__(self, path: str, limit: int = 250_000):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("pieces cross whitespace marks; the chunk table does not fit this model")
        self.table = ChunkTable(self._segment, limit)
        # What each id stands for, to see at once that a batch of chunks decodes to itself.
        self.bytes = [bytes([int(p[1:-1], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]
        self.odd: set[str] = set()
        self.eos = m.eos_id()

    def _segment(self, chunks: list[str]):
        """Decimal ids of each chunk.  The library adds a mark in front itself, so the chunk's own is taken off."""
        lone = [self.model.piece_to_id("▁")]
        ids = [i if i else lone for i in self.model.encode([c[1:] for c in chunks], num_threads=1)]  # nothing for ""
        back = b"".join(map(self.bytes.__getitem__, chain.from_iterable(ids)))
        if back != "".join(chunks).replace("▁", " ").encode():
            self.odd.update(c for c, i in zip(chunks, ids) if self.model.decode(i) != c[1:].replace("▁", " "))
        return [" ".join(map(str, i)) for i in ids]

    def encode(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """(number of ids with the end id, decimal ids joined by blanks, decoded text) of each text."""
        chunked = [split_marked(t) if t else [] for t in texts]
        out = []
        for t, chunks, values in zip(texts, chunked, self.table.look_up(chunked)):
            ids = " ".join([*values, str(self.eos)])
            if self.odd and not self.odd.isdisjoint(chunks):  # a chunk that the model does not give back
                back = self.model.decode([int(i) for i in ids.split(" ")])
            else:
                back = (t or "").replace("▁", " ")
            out.append((ids.count(" ") + 1, ids, back))
        return out


def encode_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     model_path: str | None = None, table_limit: int = 250_000) -> DataFrame:
    """(key, n_tokens, ids string, decoded) of every row; ids are decimal, joined by one blank."""
    return _map(docs, key, text, model_path, table_limit, digest=False)


def digest_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     model_path: str | None = None, table_limit: int = 250_000) -> DataFrame:
    """As ``encode_documents`` with SHA-256 digests in place of the ids and the decoded text."""
    return _map(docs, key, text, model_path, table_limit, digest=True)


def _map(docs, key, text, model_path, limit, digest):
    path = model_path or default_model()
    text_batches(docs.sparkSession)
    key_type = docs.schema[key].dataType.simpleString()
    names = ("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded")

    def run(batches):
        import hashlib

        import pyarrow as pa

        cache, name = worker_cache(), ("codec", path, limit)
        codec = cache.get(name) or cache.setdefault(name, Codec(path, limit))

        def digested(s):
            return hashlib.sha256(s.encode()).hexdigest()

        for b in batches:
            rows = codec.encode(b.column(1).to_pylist())
            if digest:
                rows = [(n, digested(i), digested(d)) for n, i, d in rows]
            n, i, d = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(i, pa.string()), pa.array(d, pa.string())],
                names=[key, "n_tokens", *names])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {key_type}, n_tokens long, {names[0]} string, {names[1]} string")
