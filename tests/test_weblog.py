from lumenflow import schemas
from lumenflow.sources import files

# A log line of 17 fields.
SAMPLE = ("00042,10.20.30.40,03/Mar/2020:07:45:10 +0100,03,Mar,03,2020,07,45,10,+0100,GET,/shop,1,/shop?a=1,"
          "reader/1.0,100")


def _parse(spark, lines):
    return files.parse_weblog(spark.createDataFrame([(line,) for line in lines], "value string"))


def test_sample_line_maps_18_columns(spark):
    good, bad = files.split_quarantine(_parse(spark, [SAMPLE]))
    assert bad.count() == 0
    r = good.first().asDict()
    assert list(r) == schemas.WEBLOG_COLUMNS
    assert r["username"] == "00042" and r["time1"] == "03" and r["statuscd"] == "100"
    assert r["referrer"] == r["referrer2"] == "reader/1.0"


def test_short_trailing_empty_and_empty_lines_are_quarantined(spark):
    sixteen = SAMPLE.rsplit(",", 1)[0]
    trailing_empty = sixteen + ","
    parsed = _parse(spark, [sixteen, trailing_empty, "", SAMPLE + ",extra,fields"])
    good, bad = files.split_quarantine(parsed)
    reasons = sorted(r["_error"] for r in bad.collect())
    assert reasons == ["empty line", "expected 17 fields, found 16", "expected 17 fields, found 16"]
    # more than 17 fields: extras ignored
    assert good.count() == 1 and good.first()["statuscd"] == "100"


def test_empty_middle_fields_are_kept(spark):
    line = SAMPLE.replace(",GET,", ",,")
    good, bad = files.split_quarantine(_parse(spark, [line]))
    assert bad.count() == 0 and good.first()["verb"] == ""


def test_read_weblog_from_file(spark, tmp_dir):
    path = f"{tmp_dir}/weblog"
    spark.createDataFrame([(SAMPLE,), ("bad,line",)], "value string").write.text(path)
    good, bad = files.read_weblog(spark, path)
    assert good.count() == 1 and bad.count() == 1
