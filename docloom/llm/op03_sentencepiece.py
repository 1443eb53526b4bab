"""SentencePiece encoding and decoding with byte offsets.

A text is normalised by longest-prefix replacement through the model's compiled
character map (a double-array trie over UTF-8 bytes plus replacement strings);
every normalised byte remembers the source byte it came from.  White space is
escaped, the piece segmentation runs on the normalised text, and each piece is
projected back through that alignment to a span of original bytes.

No piece of a model crosses a word boundary unless its vocabulary holds such a
piece; then words encode independently and each distinct word of a chunk is
encoded once.  The model is checked for this; otherwise whole normalised texts are
segmented.  Only a model that the alignment does not cover (no byte fallback, no dummy prefix,
white space as suffix or unescaped, user-defined pieces) takes the library's own spans.

The texts to hash are decoded from the ids, word by word: a word's pieces decode to
the word whatever stands before it, because only the first piece of a text loses its
white space.

Defined results: null counts as empty; an empty text (or one that the map or the
removal of extra white space empties) is the end id only and decodes to the empty text.
"""

from __future__ import annotations

import hashlib
import re
import struct
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import chunks

META = "▁"
#: distinct words a worker remembers between chunks (about 0.5 KB each)
CACHE_WORDS = 100_000


class CharsMap:
    """The compiled character map of a model: uint32 trie size, double-array
    units, then replacement strings ended by NUL.  An empty map is identity."""

    def __init__(self, blob: bytes):
        if blob:
            size = struct.unpack("<I", blob[:4])[0]
            self.units = struct.unpack(f"<{size // 4}I", blob[4:4 + size])
            self.strings = blob[4 + size:]
        else:
            self.units, self.strings = (), b""

    def longest(self, data: bytes, i: int) -> tuple[int, bytes] | None:
        """(bytes consumed, replacement) of the longest key at ``data[i:]``."""
        u = self.units
        if not u:
            return None

        def offset(x):
            return (x >> 10) << ((x & 0x200) >> 6)

        node, best = offset(u[0]), None
        for k in range(i, len(data)):
            c = data[k]
            node ^= c
            if node >= len(u) or (u[node] & 0x800000FF) != c:
                break
            unit = u[node]
            node ^= offset(unit)
            if (unit >> 8) & 1:
                at = u[node] & 0x7FFFFFFF
                best = (k + 1 - i, self.strings[at:self.strings.index(b"\0", at)])
        return best

    def apply(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes and, for each of them and the end, the source byte."""
        data = text.encode()
        if not self.units:
            return data, np.arange(len(data) + 1)
        out, at, i = bytearray(), [], 0
        while i < len(data):
            hit = self.longest(data, i)
            if hit:
                n, new = hit
            else:
                b = data[i]
                n = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
                new = data[i:i + n]
            out += new
            at += [i] * len(new)
            i += n
        return bytes(out), np.array(at + [len(data)], np.int64)


def trimmed(data: bytes, align: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Normalised bytes without leading, trailing and repeated spaces, and their alignment."""
    raw = np.frombuffer(data, np.uint8)
    space = raw == 32
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first space of a run
    last = len(data.rstrip(b" "))
    keep[:len(data) - len(data.lstrip(b" "))] = False
    keep[last:] = False
    end = align[last] if last < len(data) else align[-1]
    return raw[keep].tobytes(), np.append(align[:-1][keep], end)


class Codec:
    """Encoder and decoder of one serialised model."""

    def __init__(self, blob: bytes):
        import sentencepiece as spm
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(blob)
        spec = model.normalizer_spec
        self.map = CharsMap(spec.precompiled_charsmap)
        self.sp = spm.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.trim = spec.remove_extra_whitespaces
        self.eos = self.sp.eos_id()
        pieces = [p.piece for p in model.pieces]
        #: our own map and alignment hold; else the library's spans are taken
        self.aligned = bool(spec.add_dummy_prefix and spec.escape_whitespaces and model.trainer_spec.byte_fallback
                            and not model.trainer_spec.treat_whitespace_as_suffix
                            and not any(p.type == 4 for p in model.pieces))
        #: and words encode independently
        self.plain = self.aligned and not any(META in p.lstrip(META) for p in pieces)
        self.is_byte = np.array([p.type == 6 for p in model.pieces])
        #: bytes of normalised text that a piece stands for (white space escapes count 1)
        self.width = np.array([1 if p.type == 6 else len(p.piece.replace(META, " ").encode())
                               for p in model.pieces], np.int64)
        # segments text that is normalised already: no map, spaces as they are
        spec.precompiled_charsmap, spec.remove_extra_whitespaces = b"", False
        self.segmenter = spm.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.words: dict[str, tuple] = {}

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The text as the segmentation sees it (without the dummy prefix) and, for
        each of its bytes and the end, the source byte."""
        data, align = self.map.apply(text)
        if self.trim:
            data, align = trimmed(data, align)
        return data.decode(), align

    # -- one text
    def encode(self, text: str) -> list[tuple[int, int, int]]:
        """(id, begin, end) with original byte spans; the dummy prefix has no bytes."""
        if not self.aligned:
            return self._encode_whole(text)
        text, align = self.normalise(text)
        if self.plain:
            ids = [i for w in self.split(text) for i in self._word(w)[0]]
        else:
            ids = self.segmenter.encode(text)
        if not ids:
            return []
        ends = np.cumsum(self._widths(text, ids)) - 1  # the dummy prefix shifts by one
        ends = np.clip(ends, 0, len(align) - 1)
        begins = np.concatenate([[0], ends[:-1]])
        return list(zip(ids, align[begins].tolist(), align[ends].tolist()))

    def _widths(self, text: str, ids: list[int]) -> np.ndarray:
        """Normalised source bytes of each piece, the dummy prefix counted as one."""
        if META not in text:
            return self.width[ids]
        # an escape sign of the source is three bytes where a space is one
        raw, at, rest, out = " " + text, 0, 0, []
        for i in ids:
            if self.is_byte[i]:
                rest = rest or len(raw[at].encode())
                rest -= 1
                at += not rest
                out.append(1)
            else:
                n = len(self.sp.id_to_piece(i))
                out.append(len(raw[at:at + n].encode()))
                at += n
        return np.array(out, np.int64)

    def _encode_whole(self, text: str) -> list[tuple[int, int, int]]:
        """The library's own spans (code points of the source) as bytes."""
        proto = self.sp.encode(text, out_type="immutable_proto")
        at = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text], dtype=np.int64)])
        return [(p.id, int(at[p.begin]), int(at[p.end])) for p in proto.pieces]

    @staticmethod
    def split(text: str) -> list[str]:
        """Words with the escaped white space before them."""
        return _WORD.findall(META + text.replace(" ", META)) if text else []

    def _word(self, w: str) -> tuple:
        self.learn([w])
        return self.words[w]

    def learn(self, words) -> None:
        """Encode the words not known yet: (ids, decimal ids, decoded text, its bytes)."""
        new = [w for w in set(words) if w not in self.words]
        if not new:
            return
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words.clear()
            new = list(set(words))
        found = self.segmenter.encode([w[1:].replace(META, " ") for w in new], num_threads=1)
        # a final space is its own piece; alone it would be an empty text
        found = [ids or [self.sp.piece_to_id(META)] for ids in found]
        for w, ids, text in zip(new, found, self.segmenter.decode(found, num_threads=1)):
            self.words[w] = (ids, " ".join(map(str, ids)), " " + text, len(text.encode()) + 1)

    # -- many texts
    def digest(self, texts: list[str], keep_ids: bool = False) -> pd.DataFrame:
        """Per text: number of ids, digests of ids and of the decoded text, how
        many source bytes the projected spans cover, and the ids if asked for."""
        rows, kept = [], []
        if self.plain:
            if self.map.units or self.trim:
                words = [self.split(self.normalise(t)[0]) for t in texts]
            else:
                words = [self.split(t) for t in texts]
            self.learn({w for ws in words for w in ws})
            known = self.words
            for t, ws in zip(texts, words):
                got = [known[w] for w in ws] if all(map(known.__contains__, ws)) else [self._word(w) for w in ws]
                ids = " ".join([g[1] for g in got])
                n = sum([len(g[0]) for g in got])
                decoded = "".join([g[2] for g in got])[1:]
                if keep_ids:
                    kept.append(np.array([*chain.from_iterable([g[0] for g in got]), self.eos], np.int32))
                rows.append((n + 1, (ids + " " if ids else "") + str(self.eos), decoded,
                             self._covered(t, got)))
        else:
            for t in texts:
                spans = self.encode(t)
                ids = [s[0] for s in spans] + [self.eos]
                kept.append(np.array(ids, np.int32))
                rows.append((len(ids), " ".join(map(str, ids)), self.sp.decode(ids),
                             spans[-1][2] if spans else 0))
        out = pd.DataFrame([(n, _sha(i), _sha(d), c) for n, i, d, c in rows],
                           columns=["n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"])
        if keep_ids:
            out["ids"] = kept
        return out

    def _covered(self, text: str, got: list) -> int:
        """End of the last projected span."""
        if not got:
            return 0
        if not self.map.units and not self.trim and META not in text:
            return int(self.width[got[-1][0]].sum()) - 1 + sum([g[3] for g in got[:-1]])
        spans = self.encode(text)
        return spans[-1][2]


_WORD = re.compile(f"{META}+[^{META}]*")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def read_model(path: str) -> bytes:
    """The model file (fixed size, about 0.5 MB), shipped to the workers with the job."""
    with open(path, "rb") as f:
        return f.read()


def encode_docs(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                keep_ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256, covered_bytes and, if asked
    for, ids for every row (the end id counts)."""
    blob = read_model(model_path)

    def run(batches):
        codec = Codec(blob)
        for batch, text in chunks(batches, "text"):
            out = codec.digest(text.to_pylist(), keep_ids)
            columns = [batch.column(0), pa.array(out["n_tokens"], pa.int64()), pa.array(out["ids_sha256"], pa.string()),
                       pa.array(out["decoded_sha256"], pa.string()), pa.array(out["covered_bytes"], pa.int64())]
            if keep_ids:
                ends = np.concatenate([[0], np.cumsum([len(x) for x in out["ids"]])])
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(out["ids"].tolist()))))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes", *["ids"] * keep_ids]
    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"{id_col} {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string, covered_bytes long"
        + ", ids array<int>" * keep_ids)


def encode_spans(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces themselves: id, ids, begins, ends (original byte offsets)."""
    blob = read_model(model_path)

    def run(batches):
        codec = Codec(blob)
        for pdf in batches:
            spans = [codec.encode(t) for t in pdf["text"].fillna("")]
            yield pd.DataFrame({id_col: pdf["id"], **{
                name: [[s[k] for s in x] for x in spans] for k, name in enumerate(("ids", "begins", "ends"))}})

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(
        run, f"{id_col} {id_type}, ids array<int>, begins array<long>, ends array<long>")

