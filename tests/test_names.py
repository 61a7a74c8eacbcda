from pyspark.sql import functions as F

from cairnsift.functions import names, policy, text, tokens
from tests.util import one


def test_member_key_collapses_vendor_folders(spark):
    assert one(spark, names.member_key("p"), p="\\Batch\\S1.D\\AcqData\\x.bin") == "batch/s1.d"
    assert one(spark, names.member_key("p"), p="/a/b.raw/") == "a/b.raw"
    assert one(spark, names.member_key("p"), p="x.d/y.raw/z") == "x.d"


def test_raw_like(spark):
    cases = {"a/S1.RAW": True, "a/S1.d/x": True, "__MACOSX/S1.raw": False, "a/._S1.raw": False, "readme.txt": False,
             "a\\._x.raw": False, "S1.raw/": True, "x.wiff2": True, "x.wiff.scan": False}
    frame = spark.createDataFrame(list(cases.items()), "p string, want boolean")
    assert frame.where(names.is_raw_like("p") != F.col("want")).count() == 0


def test_stem_and_loose_stem(spark):
    assert one(spark, names.stem("p"), p="a/Inj_1.mzML") == "Inj_1"
    assert one(spark, names.loose_stem("p"), p="Run7_B2_XYposMSMS.d") == one(spark, names.loose_stem("p"), p="run7_b2_XYMSMS.raw")


def test_encoding_ranks(spark):
    want = {"q.RAW": 0, "in/q.d": 0, "q.wiff": 0, "q.raw.gz": 0, "q.tdf": 0, "q.ibf": 1, "q.CDF": 1, "q.mzml": 2, "q.mzML.zip": 2, "q.imzml": 2,
            "q.mzxml": 3, "q.mzXML.gz": 3, "q.mzdata": None, "q.wiff.scan": None, "notes.md": None}
    got = {r["p"]: r["x"] for r in spark.createDataFrame([(p,) for p in want], "p string").select("p", names.encoding_rank("p").alias("x")).collect()}
    assert got == want
    assert one(spark, names.encoding_stem("p"), p="up/Q7.d.zip") == "q7"


def test_path_polarity_reads_folders_only(spark):
    assert one(spark, names.path_polarities("p"), p="NEG/q.raw") == ["negative"]
    assert one(spark, names.path_polarities("p"), p="neg_q_2.raw") == []
    assert one(spark, names.path_polarities("p"), p="qc_neg/pos_q.raw") == ["negative"]


def test_glob(spark):
    pattern = names.glob_to_regex("run[!2]/*_p?s.*")
    assert one(spark, F.col("p").rlike(pattern), p="run1/a_pos.raw") is True
    assert one(spark, F.col("p").rlike(pattern), p="run2/a_pos.raw") is False


def test_polarity_needs_one_value(spark):
    assert one(spark, tokens.token_polarity("p"), p="pos/x_NEG.raw") is None
    assert one(spark, tokens.token_polarity("p"), p="S1_Pos.raw") == "positive"
    assert one(spark, tokens.token_polarity("p"), p="Position.raw") is None


def test_acquisition_words_start_a_word(spark):
    assert one(spark, tokens.token_acquisition("p"), p="posDDA_media1_Lydia") == ["DDA"]
    assert one(spark, tokens.token_acquisition("p"), p="x_targeted-dd-MS2 HDMSe_dia2") == ["DIA2", "MSe", "tDDA"]


def test_level_words_read_each_span_once(spark):
    assert one(spark, tokens.ms_level_words("p"), p="negMSMS_MS1_MSLIB") == ["MS/MS:MSMS", "MS-only:MS1"]


def test_acquisition_problem(spark):
    assert one(spark, tokens.acquisition_problem("p", F.lit("MS1")), p="x_MSMS.raw") == "product_ions:MSMS"
    assert one(spark, tokens.acquisition_problem("p", F.lit("SWATH")), p="x_DIA.raw") is None
    assert one(spark, tokens.acquisition_problem("p", F.lit("targeted_DDA")), p="x_DDA.raw") is None
    assert one(spark, tokens.acquisition_problem("p", F.lit("mixed")), p="x_DIA.raw") is None


def test_methods_outside_identifiers(spark):
    assert one(spark, tokens.methods_named("p"), p="ead1 0a1b2c3d-ead2-4f5e-8a9b-c0d1e2f3a4b5 7ead9f3c") == []
    assert one(spark, tokens.methods_named("p"), p="ETD, EThcD then etd") == ["ETD", "EThcD"]
    assert one(spark, tokens.methods_named("p", words=True), p="by Electron-Capture dissociation") == ["ECD"]


def test_instruments(spark):
    assert one(spark, tokens.instrument_can(F.lit("EAD"), "p"), p="SCIEX ZenoTOF 7600") is True
    assert one(spark, tokens.instrument_can(F.lit("EAD"), "p"), p="Agilent 6545") is False
    assert one(spark, tokens.instrument_can(F.lit("EAD"), "p"), p=" N/A ") is True
    assert one(spark, tokens.instrument_can(F.lit("ETD"), "p"), p="Bruker") is True


def test_portable_paths(spark):
    at = lambda p: one(spark, text.portable_path("p", F.lit("D:\\W\\U1\\raw")), p=p)
    assert at("d:/w/u1/RAW") == "." and at("D:\\w\\U1\\raw\\a\\b.raw") == "a/b.raw"
    assert at("D:\\w\\U1\\out\\c") == "../out/c" and at("\\\\srv\\x\\y.lib") == "<external>/y.lib" and at("rel/x") == "rel/x"


def test_redaction_of_locations(spark):
    out = one(spark, text.redact("p", {"main": "C:\\lib\\main.msp"}), p='{"a": "c:\\\\LIB\\\\main.msp", "b": "C:/lib/other"}')
    assert out == '{"a": "<library:main>", "b": "<library-directory>/other"}'


def test_canonical_json_keeps_nulls_and_sorts(spark):
    assert one(spark, text.canonical_json({"b": F.lit(None).cast("string"), "a": F.lit('x"\n')})) == '{"a":"x\\"\\n","b":null}'


def test_size_labels_round_half_even(spark):
    assert [one(spark, text.size_label(F.lit(n).cast("bigint"))) for n in (12, 1280, 3 << 20, 5 << 30)] == ["12 B", "1.2 kB", "3.0 MB", "5.0 GB"]


def test_legacy_versions(spark):
    assert [one(spark, text.legacy_policy("v"), v=v) for v in ("1.2.9", "1.3.0", "1.10", "dev", "")] == [True, False, False, False, False]


def test_network_and_limits(spark):
    none = F.lit(None)
    assert one(spark, policy.network_failure(F.lit("failed"), F.col("p"), none.cast("string"), none.cast("boolean")), p="HTTP Error 503") is True
    assert one(spark, policy.network_failure(F.lit("failed"), F.col("p"), none.cast("string"), none.cast("boolean")), p="HTTP Error 404") is False
    assert one(spark, policy.network_failure(F.lit("stalled"), F.col("p"), none.cast("string"), none.cast("boolean")), p="") is True
    assert one(spark, policy.lease_size_limit(F.col("p")), p="Download exceeded the 10-byte safety limit") == 11
    assert one(spark, policy.extraction_disk_short(F.col("p")), p="insufficient_disk_space") == 0
