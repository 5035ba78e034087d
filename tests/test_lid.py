import random
import uuid

import pytest
from pyspark.sql import functions as F

from sampletide.functions import lid, sql

FIELDS = tuple(name for name, _, _ in lid.HIGH_FIELDS + lid.LOW_FIELDS)
SHIFTS = tuple(shift + 64 for _, _, shift in lid.HIGH_FIELDS) + tuple(shift for _, _, shift in lid.LOW_FIELDS)
WIDTHS = tuple(width for _, width, _ in lid.HIGH_FIELDS + lid.LOW_FIELDS)
_RANDOM = random.Random(5)
CASES = [tuple(_RANDOM.getrandbits(w) for w in WIDTHS) for _ in range(6)] + [(5, 2, 3, 4, 5, 6, 7, 1),
    tuple(0 for _ in WIDTHS), tuple((1 << w) - 1 for w in WIDTHS), *(tuple((1 << w) - 1 if i == j else 0 for j, w in enumerate(WIDTHS)) for i in range(len(WIDTHS)))]
SCHEMA = ", ".join(f"{f} long" for f in FIELDS)


def number(case):
    return sum(v << s for v, s in zip(case, SHIFTS))


def crockford(n):
    return "".join(lid.CROCKFORD[(n >> (125 - 5 * i)) & 31] for i in range(26))


@pytest.fixture(scope="module")
def minted(spark):
    rows = spark.createDataFrame(CASES, SCHEMA)
    return rows.withColumn("lid", lid.mint_text(*FIELDS))


def test_text_is_the_number(minted):
    for row in minted.collect():
        assert row["lid"] == str(uuid.UUID(int=number(tuple(row[f] for f in FIELDS))))


def test_crockford_text_is_the_number(minted):
    for row in minted.select(*FIELDS, lid.crockford().alias("t")).collect():
        assert row["t"] == crockford(number(tuple(row[f] for f in FIELDS)))


def test_decode_and_slices(minted):
    rows = minted.select(*FIELDS, lid.decode().alias("d"), lid.layer().alias("sl"), lid.file().alias("sf"), lid.run().alias("sr"),
                         lid.channel().alias("sc"), lid.ts_ms().alias("st"), lid.is_canary().alias("sb")).collect()
    for r in rows:
        assert tuple(r["d"]) == tuple(r[f] for f in FIELDS)
        assert (r["sl"], r["sf"], r["sr"], r["sc"], r["st"], r["sb"]) == (
            r["layer"], r["file"], r["run"], r["channel"], r["ts_ms"], r["radioactive"] == 1)


def test_words_roundtrip(minted):
    words = minted.select("lid", lid.hi_word().alias("hi"), lid.lo_word().alias("lo"))
    assert words.where(lid.to_text("hi", "lo") != F.col("lid")).count() == 0


def test_crockford_both_ways(minted):
    rows = minted.select(*FIELDS, "lid", lid.crockford().alias("t")).withColumn(
        "back", lid.from_crockford("lower(t)")).collect()
    for r in rows:
        assert r["t"] == crockford(number(tuple(r[f] for f in FIELDS)))
        assert r["back"] == r["lid"]


@pytest.mark.parametrize("bad", ["", "0" * 25, "0" * 27, "U" * 26, "8" + "0" * 25])
def test_parse_refuses(spark, bad):
    rows = spark.createDataFrame([(bad,)], "t string").select(lid.from_crockford("t").alias("lid"))
    with pytest.raises(Exception, match="26 character"):
        rows.collect()


@pytest.mark.parametrize("field", range(8))
def test_mint_refuses_out_of_range(spark, field):
    case = [1] * 8
    case[field] = (2**48, 16, 256, 65536, 16, 1024, 1024, 2)[field]
    with pytest.raises(Exception, match=FIELDS[field]):
        spark.createDataFrame([tuple(case)], SCHEMA).select(lid.mint_text(*FIELDS)).collect()


def test_prefix_form_equals_mint(minted):
    low = minted.where("segment = 0")
    built = low.withColumn("p", lid.file_prefix("ts_ms", "layer", "experiment", "file"))
    assert built.where(lid.with_prefix("p", "run", "channel", "radioactive") != F.col("lid")).count() == 0


def test_layers(minted):
    at_two = minted.where("layer = 2")
    down = at_two.withColumn("below", lid.relayer("lid", 2))
    assert down.where(lid.layer("below") != 3).count() == 0
    assert down.where(lid.parent("below") != F.col("lid")).count() == 0
    with pytest.raises(Exception, match="expected layer 1"):
        minted.select(lid.relayer("lid", 1)).collect()
    with pytest.raises(Exception, match="no layer below"):
        minted.select(lid.relayer("lid", 15)).collect()
    with pytest.raises(Exception, match="no parent"):
        minted.where("layer = 1").select(lid.parent()).collect()


def test_null_stays_null(spark):
    row = spark.sql("SELECT cast(null as string) AS lid").select(lid.relayer("lid", 1), lid.parent(), lid.crockford(), lid.layer()).first()
    assert tuple(row) == (None, None, None, None)


def test_sql_names(spark, minted):
    sql.register(spark)
    minted.createOrReplaceTempView("minted")
    assert {r["t"].year for r in spark.sql("SELECT lid_time(lid) AS t FROM minted WHERE ts_ms = 0").collect()} == {1970}
    rows = spark.sql(f"""SELECT *, lid_encode({', '.join(FIELDS)}) AS e, lid_decode(lid_from_uuid(lid)) AS d, lid_text(lid) AS t, lid_parse(lid_text(lid)) AS p,
        lid_radioactive(lid_from_uuid(lid)) AS r FROM minted""").collect()
    for row in rows:
        case = tuple(row[f] for f in FIELDS)
        assert row["e"] == row["p"] == row["lid"] and tuple(row["d"]) == case and row["t"] == crockford(number(case))
        assert row["r"] == row["radioactive"]
    up = spark.sql("SELECT lid_parent(lid_relayer(lid, 2)) = lid AS same FROM minted WHERE layer = 2").collect()
    assert [r["same"] for r in up] == [True]
