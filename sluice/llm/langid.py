"""Language identification by compression.

For each language a raw-content zstandard dictionary is made from a bounded sample of labelled
texts. A text is cut into blocks of equal size and every block is compressed with every
dictionary; the language whose dictionary gives the fewest bytes in all wins. When the runner-up
needs hardly more bytes, the text is rejected: its language is not among those learned. How much
is hardly, by the length of the text, comes from labelled pieces that no dictionary holds: from the
margins that they have, and those that they would have had their own language not been learned.

Every dictionary ends with the same bytes, and every block starts with them: the match that they
give pays for the parts of a frame that a short block could not, so that a few words already show
in the size.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import first_by_hash, give_back, quoted, ship

UNKNOWN = "und"
#: Labelled rows per language that are learned from, at most.
ROWS = 400
#: Characters taken from each of these rows.
PIECE = 1000
#: Bytes of a dictionary, at most.
DICTIONARY = 32_000
#: Languages that are learned, at most, those with the most labelled rows; tasks hold their dictionaries.
LANGUAGES = 256
#: Bytes compressed at once.
BLOCK = 1024
#: A text is rejected when the runner-up needs less than this share of bytes more, if there are
#: too few labelled pieces of its length to tell.
MARGIN = 0.02
#: Bytes of letters below which, without such pieces, the best guess stands.
LEAST = 64
#: Lengths in bytes of letters, each with its own limit; the last is for all that are longer.
LENGTHS = (16, 32, 64, 128, 256, 512, 1024)
#: Pieces that limits are set from, at most, and of one length, at least.
TRIALS, ENOUGH = 800, 40
#: Share of unlearned languages' pieces that go, unless more than this share of known ones would.
GO, LOSE = 0.98, 0.01
#: What dictionaries end with and blocks start with.
CARRIER = hashlib.blake2b(b"carrier", digest_size=48).digest()
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """Lower-case words of letters with single spaces between, in UTF-8."""
    return _OTHER.sub(" ", text.lower()).strip().encode("utf-8", "replace")


@dataclass
class Languages:
    """Dictionaries by language; compressors are made once per process."""

    dictionaries: dict[str, bytes]
    #: Search for matches less thoroughly, in half the time.
    fast: bool = False
    #: Pieces by language that are in no dictionary.
    others: dict[str, list[bytes]] = field(default_factory=dict, repr=False)
    _ready: list | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {"dictionaries": self.dictionaries, "fast": self.fast, "others": {}, "_ready": None}

    def _compressors(self) -> list:
        if self._ready is None:
            import zstandard

            strategy = zstandard.STRATEGY_LAZY if self.fast else zstandard.STRATEGY_BTOPT
            self._ready = []
            for name in sorted(self.dictionaries):
                content = b" " + self.dictionaries[name] + b" " + CARRIER
                made = zstandard.ZstdCompressor(
                    dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                    compression_params=zstandard.ZstdCompressionParameters.from_level(
                        3,
                        source_size=BLOCK,
                        dict_size=DICTIONARY,
                        strategy=strategy,
                        min_match=3,
                        write_content_size=False,
                        write_dict_id=False,
                    ),
                )
                self._ready.append((name, made.compress))
        return self._ready

    def sizes(self, content: bytes) -> list[tuple[int, str]]:
        """Bytes that each language needs for the whole content, fewest first."""
        blocks = [CARRIER + b" " + content[i : i + BLOCK] + b" " for i in range(0, len(content), BLOCK)]
        return sorted((sum([len(pack(b)) for b in blocks]), name) for name, pack in self._compressors())

    def best(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin. `und` with 0 if the text has no letter."""
        return self._best(letters(text) if text else b"")

    def judge(self, text: str | None, limits: list[float]) -> tuple[str, float, float, bool]:
        """The same, and whether the text is rejected."""
        content = letters(text) if text else b""
        name, score, margin = self._best(content)
        place = min(bisect_right(LENGTHS, len(content)), len(LENGTHS) - 1)
        return name, score, margin, name == UNKNOWN or margin < limits[place]

    def _best(self, content: bytes) -> tuple[str, float, float]:
        if not content or not self.dictionaries:
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(content)
        least = sizes[0][0]
        if len(sizes) == 1:
            return sizes[0][1], 1.0, 1.0
        score = 1 / sum(math.exp(-40 * (size - least) / least) for size, _ in sizes)
        return sizes[0][1], score, (sizes[1][0] - least) / least

    def limits(self) -> list[float]:
        """For each of LENGTHS the margin below which a text is rejected."""
        out = [0.0 if n <= LEAST else MARGIN for n in LENGTHS]
        names = [n for n in sorted(self.others) if n in self.dictionaries]
        if len(self.dictionaries) < 2 or not names:
            return out
        each = max(4, TRIALS // len(names))
        for i, length in enumerate(LENGTHS):
            known, unlearned = [], []
            for name in names:
                for piece in self.others[name][:each]:
                    part = piece[: length * 3 // 4]
                    if len(part) < length // 2:
                        continue
                    sizes = self.sizes(part)
                    known.append((sizes[1][0] - sizes[0][0]) / sizes[0][0])
                    left = [size for size, of in sizes if of != name]
                    if len(left) > 1:
                        unlearned.append((left[1] - left[0]) / left[0])
            if len(known) >= ENOUGH:
                kept = sorted(known)[int(LOSE * len(known))]
                out[i] = min(kept, sorted(unlearned)[int(GO * len(unlearned))] if unlearned else MARGIN)
        return out


def learn(
    docs: DataFrame,
    use: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = ROWS,
    fast: bool = False,
) -> Languages:
    """Dictionaries from at most `rows` rows per language, chosen by a hash of the id.

    Rows with a null language or text, or for which `use` is not true, are not learned from. Of a
    chosen text a piece of `PIECE` characters counts, at a place given by the hash. The driver
    gets at most `rows` pieces for each of at most `LANGUAGES` languages; texts of others are of no
    learned language. An empty table, or one without labels, gives no languages.
    """
    usable = F.lit(True) if use is None else use
    known = docs.filter(usable & quoted(lang_col).isNotNull() & quoted(text_col).isNotNull())
    known = known.select(
        quoted(lang_col).cast("string").alias("lang"),
        F.xxhash64(quoted(id_col)).alias("order"),
        quoted(text_col).cast("string").alias("text"),
    )
    length = F.char_length("text")
    place = F.pmod(F.col("order"), F.greatest(length - PIECE, F.lit(0)) + 1).cast("int") + 1
    pieces = known.select("lang", "order", F.substring("text", place, F.lit(PIECE)).alias("piece"))
    gathered: dict[str, list[bytes]] = {}
    for row in first_by_hash(pieces, "lang", "order", rows, LANGUAGES).orderBy("lang", "order", "piece").collect():
        gathered.setdefault(row.lang, []).append(letters(row.piece))
    share = {name: b" ".join(p for p in parts if p)[:DICTIONARY] for name, parts in gathered.items()}
    kept = {name: content for name, content in share.items() if len(content) >= 8}
    others = {name: [p for p in dict.fromkeys(gathered[name]) if p not in kept[name]] for name in kept}
    return Languages(kept, fast, others)


def _guessed(docs: DataFrame, languages: Languages, text_col: str, margin: float | None) -> DataFrame:
    """Rows as `row`, with `guess`. A `margin` stands for all texts of LEAST bytes of letters."""
    limits = languages.limits() if margin is None else [0.0 if n <= LEAST else margin for n in LENGTHS]
    ship(docs.sparkSession)
    kind = T.StructType(
        [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("margin", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )

    @F.arrow_udf(kind)
    def guess(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [languages.judge(text.as_py(), limits) for text in batch]
            columns = list(zip(*found)) or [(), (), (), ()]
            types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["lang_pred", "score", "margin", "rejected"]
            )
        give_back()

    own = [quoted(c) for c in docs.columns]
    return docs.select(F.struct(*own).alias("row"), guess(quoted(text_col).cast("string")).alias("guess"))


def identify(
    docs: DataFrame, languages: Languages, text_col: str = "text", margin: float | None = None
) -> DataFrame:
    """All columns of `docs` and `lang_pred`, `score` (0 to 1), `margin` and `rejected`.

    Texts go by the languages' own limits, or with `margin` by this one.

    A null text, one without a letter, or any text if no language was learned, is `und` with
    score 0, and rejected. Columns of `docs` with these names are replaced. An empty table gives
    no rows.
    """
    own = [c for c in docs.columns if c not in ("lang_pred", "score", "margin", "rejected")]
    columns = [F.col("row").getField(c).alias(c) for c in own]
    return _guessed(docs, languages, text_col, margin).select(*columns, "guess.*")


def accepted(
    docs: DataFrame, languages: Languages, text_col: str = "text", margin: float | None = None
) -> DataFrame:
    """The rows of `docs`, with all their columns, that `identify` does not reject.

    Null texts, those without a letter and, if no language was learned, all texts go. Repeated rows
    stay or go alike; an empty table gives no rows.
    """
    return _guessed(docs, languages, text_col, margin).filter("not guess.rejected").select("row.*")
