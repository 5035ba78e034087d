"""The 128-bit lineage id as Spark columns.

In flight the id is two BIGINT words, which is legal because no field straddles bit 64. At rest it is
36-character lower-case text, so text order is numeric order: min, max, BETWEEN and Parquet row-group
pruning work on it without decoding. Every field down to `run` starts on a hex digit, so hot paths read
or replace one digit of the text and never parse the id.

    high word: ts_ms 48 bits | layer 4 | experiment 8 | reserved 4
    low word:  file 16 | run 4 | channel 10 | segment 10 | radioactive 1 | reserved 23

Arguments are SQL fragments: a column name, a number or an expression. `text` holds the SQL of each function,
which `functions.sql` also registers under SQL names; the functions here return it as a Column.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field name, width in bits, shift inside its word.
HIGH_FIELDS = (("ts_ms", 48, 16), ("layer", 4, 12), ("experiment", 8, 4))
LOW_FIELDS = (("file", 16, 48), ("run", 4, 44), ("channel", 10, 34), ("segment", 10, 24), ("radioactive", 1, 23))
CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"

# Bounds that follow from the field widths. They are what makes a per-file table broadcastable.
MAX_FILES = (1 << 16) - 1
MAX_EXPERIMENTS = (1 << 8) - 1
RESERVED_LOW = (1 << 23) - 1
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _fail(message: str, as_type: str) -> str:
    return f"cast(raise_error({message}) as {as_type})"


def _in_range(name: str, value, width: int) -> str:
    if isinstance(value, int):
        if not 0 <= value < 1 << width:
            raise ValueError(f"lineage id: {name} does not fit {width} bits: {value}")
        return f"{value}L"
    message = f"concat('lineage id: {name} does not fit {width} bits: ', ({value}))"
    return f"if(({value}) not between 0 and {(1 << width) - 1}L, {_fail(message, 'bigint')}, cast(({value}) as bigint))"


def _pack(layout, values: dict) -> str:
    return " | ".join(f"shiftleft({_in_range(name, values[name], width)}, {shift})" for name, width, shift in layout)


def _named(ts_ms, layer, experiment, file, run, channel, segment, radioactive) -> dict:
    return dict(ts_ms=ts_ms, layer=layer, experiment=experiment, file=file, run=run, channel=channel,
                segment=segment, radioactive=radioactive)


def _number(hex_text: str) -> str:
    return f"cast(conv({hex_text}, 16, 10) as bigint)"


def _hi(lid: str) -> str:
    """32 bits at a time, because 16 hex digits overflow a signed cast."""
    return f"(shiftleft({_number(f'substr({lid}, 1, 8)')}, 32) | {_number(f'concat(substr({lid}, 10, 4), substr({lid}, 15, 4))')})"


def _lo(lid: str) -> str:
    return f"(shiftleft({_number(f'concat(substr({lid}, 20, 4), substr({lid}, 25, 4))')}, 32) | {_number(f'substr({lid}, 29, 8)')})"


def _decode(hi: str, lo: str) -> str:
    fields = [f"'{name}', shiftrightunsigned({word}, {shift}) & {(1 << width) - 1}L"
              for word, layout in ((hi, HIGH_FIELDS), (lo, LOW_FIELDS)) for name, width, shift in layout]
    return f"named_struct({', '.join(fields)})"


def _words_text(hi: str, lo: str) -> str:
    return _dashed(f"lower(concat(lpad(hex({hi}), 16, '0'), lpad(hex({lo}), 16, '0')))")


def _slice(lid: str, position: int, length: int) -> str:
    """Bytes of the id. Finding a character in text walks all characters before it, which measured four times
    slower over tens of millions of rows."""
    return f"substr(cast({lid} as binary), {position}, {length})"


def _byte(digit: str) -> str:
    return f"X'{ord(digit):02X}'"


def _with_layer(lid: str, digit: str) -> str:
    return f"cast(overlay(cast({lid} as binary) placing {digit} from 15 for 1) as string)"


def _relayer(lid: str, expected: int) -> str:
    if not 0 <= expected < 15:
        return _fail(f"'lineage id: layer {expected} has no layer below'", "string")
    message = f"concat('lineage id: expected layer {expected}, found ', substr({lid}, 15, 1))"
    return (f"if({_slice(lid, 15, 1)} <> {_byte(f'{expected:x}')}, {_fail(message, 'string')}, "
            f"{_with_layer(lid, _byte(f'{expected + 1:x}'))})")


def _parent(lid: str) -> str:
    layer = _number(f"substr({lid}, 15, 1)")
    return (f"if({layer} <= 1, {_fail(repr('lineage id: a Bronze id has no parent'), 'string')}, "
            f"{_with_layer(lid, f'cast(lower(hex({layer} - 1)) as binary)')})")


# conv writes base 32 as 0-9A-V; the id's text leaves out I, L, O and U.
_PLAIN, _CROCKFORD = "IJKLMNOPQRSTUV", "JKMNPQRSTVWXYZ"


def _crockford(lid: str) -> str:
    """26 characters of five bits. The time is exactly the first ten; the other 80 bits are two groups of eight
    characters or ten hex digits, so each group converts as one number."""
    digits = f"replace({lid}, '-', '')"
    parts = [f"lpad(conv(substr({digits}, {start}, {length}), 16, 32), {width}, '0')"
             for start, length, width in ((1, 12, 10), (13, 10, 8), (23, 10, 8))]
    return f"translate(concat({', '.join(parts)}), '{_PLAIN}', '{_CROCKFORD}')"


def _dashed(digits: str) -> str:
    """Dashes set into 32 hex digits, from the right."""
    text = f"cast({digits} as binary)"
    for position in (21, 17, 13, 9):
        text = f"overlay({text} placing X'2D' from {position} for 0)"
    return f"cast({text} as string)"


def _from_crockford(text: str) -> str:
    """The id of a text; an error unless it is 26 characters of the alphabet that fit 128 bits."""
    bad = _fail(f"concat('lineage id: not a 26 character id: ', {text})", "string")
    plain = (f"translate(if(upper({text}) not rlike '^[0-7][{CROCKFORD}]{{25}}$', {bad}, upper({text})), "
             f"'{_CROCKFORD}', '{_PLAIN}')")
    parts = [f"lpad(conv(substr({plain}, {start}, {length}), 32, 16), {width}, '0')"
             for start, length, width in ((1, 10, 12), (11, 8, 10), (19, 8, 10))]
    return _dashed(f"lower(concat({', '.join(parts)}))")


def _ts_ms(lid: str) -> str:
    return _number(f"concat(substr({lid}, 1, 8), substr({lid}, 10, 4))")


def _from_epoch_ms(ms: str) -> str:
    return f"timestampadd(MILLISECOND, {ms}, {EPOCH})"


text = SimpleNamespace(hi=_hi, lo=_lo, decode=_decode, words_text=_words_text, relayer=_relayer, parent=_parent,
                       crockford=_crockford, from_crockford=_from_crockford, ts_ms=_ts_ms, from_epoch_ms=_from_epoch_ms,
                       pack=_pack, named=_named, slice=_slice, number=_number)


def mint(*fields) -> Column:
    """struct<hi, lo> of the eight fields in layout order; a value outside its field fails the job."""
    values = _named(*fields)
    return F.expr(f"named_struct('hi', {_pack(HIGH_FIELDS, values)}, 'lo', {_pack(LOW_FIELDS, values)})")


def mint_text(*fields, reserved: int = 0) -> Column:
    """The id as text; `reserved` fills the low reserved bits, for the upper bound of a prefix."""
    values = _named(*fields)
    return F.expr(_words_text(_pack(HIGH_FIELDS, values), f"({_pack(LOW_FIELDS, values)} | {reserved}L)"))


def to_text(hi: str, lo: str) -> Column:
    return F.expr(_words_text(hi, lo))


def hi_word(lid: str = "lid") -> Column:
    return F.expr(_hi(lid))


def lo_word(lid: str = "lid") -> Column:
    return F.expr(_lo(lid))


def decode(lid: str = "lid") -> Column:
    """struct of the eight fields."""
    return F.expr(_decode(_hi(lid), _lo(lid)))


def layer(lid: str = "lid") -> Column:
    return F.expr(f"cast({_number(f'substr({lid}, 15, 1)')} as int)")


def file(lid: str = "lid") -> Column:
    return F.expr(f"cast({_number(f'substr({lid}, 20, 4)')} as int)")


def run(lid: str = "lid") -> Column:
    return F.expr(f"cast({_number(f'substr({lid}, 25, 1)')} as smallint)")


def channel(lid: str = "lid") -> Column:
    return F.expr(f"cast(shiftright({_number(f'substr({lid}, 26, 3)')}, 2) as smallint)")


def ts_ms(lid: str = "lid") -> Column:
    return F.expr(_ts_ms(lid))


def is_canary(lid: str = "lid") -> Column:
    """The radioactive bit is the top bit of one hex digit, so no decoding is needed."""
    return F.expr(f"{_slice(lid, 31, 1)} >= {_byte('8')}")


def file_key(lid: str = "lid") -> Column:
    """The file field as its four hex digits: a join key that needs no decoding."""
    return F.expr(_slice(lid, 20, 4))


def file_key_of(ingest_ord: str) -> Column:
    return F.expr(f"cast(lpad(lower(hex({ingest_ord})), 4, '0') as binary)")


def file_prefix(ts_ms, layer, experiment, file) -> Column:
    """Everything before the run digit: the same for all records of one file, so computed once per file."""
    return F.substring(mint_text(ts_ms, layer, experiment, file, 0, 0, 0, 0), 1, 24)


def with_prefix(prefix: str, run, channel, radioactive) -> Column:
    """Id of a record from its file's prefix. A bit above the run keeps the leading zeros of the twelve digits."""
    values = {"file": 0, "run": run, "channel": channel, "segment": 0, "radioactive": radioactive}
    low = f"hex({_pack(LOW_FIELDS, values)} | {1 << 48}L)"
    return F.expr(f"concat({prefix}, lower(substr({low}, 2, 12)))")


def relayer(lid: str, expected: int) -> Column:
    """One layer down; fails on another layer than `expected` or when no layer is left."""
    return F.expr(_relayer(lid, expected))


def parent(lid: str = "lid") -> Column:
    """One layer up; fails at Bronze."""
    return F.expr(_parent(lid))


def from_epoch_ms(ms: str) -> Column:
    """UTC timestamp without zone, independent of the session zone."""
    return F.expr(_from_epoch_ms(ms))


def epoch_ms(ts: str) -> Column:
    return F.expr(f"timestampdiff(MILLISECOND, {EPOCH}, {ts})")


def to_millisecond(ts: str) -> Column:
    return F.expr(_from_epoch_ms(f"timestampdiff(MILLISECOND, {EPOCH}, {ts})"))


def time(lid: str = "lid") -> Column:
    return F.expr(_from_epoch_ms(_ts_ms(lid)))


def crockford(lid: str = "lid") -> Column:
    """26-character text of an id."""
    return F.expr(_crockford(lid))


def from_crockford(text: str) -> Column:
    """Id of a 26-character text; fails unless it is one of the alphabet that fits 128 bits."""
    return F.expr(_from_crockford(text))
