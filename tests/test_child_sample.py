"""The whole survey job on a hand-made village, through files."""

import pytest
from pyspark.sql import functions as F

from frames import frame, rows
from kinfold.catalog.survey import survey_tables
from kinfold.functions.money import BASE_INDEX
from kinfold.plans import child_sample as cs
from kinfold.plans.recodes import VALUE_LABELS
from kinfold.sources.labels import caption_of, load_labelled
from kinfold.sources.tables import read_table, write_table


def _typed(spark, like, *records):
    """A frame with the columns of ``like``; columns not named in a record are missing."""
    schema = ", ".join(f"{name} {kind}" for name, kind in like.dtypes)
    return spark.createDataFrame([tuple(r.get(c) for c in like.columns) for r in records], schema)


@pytest.fixture(scope="module")
def village(spark):
    """Household 1: mother 1, father 2, pupils 3 and 4, a grandmother without a follow-up. Household 2: one pupil."""
    like = survey_tables(spark, "/root/testdata/sf0.001")
    make = lambda name, *records: _typed(spark, like[name], *records)
    home = {"y3_hhid": 1}
    tables = {
        "roster": make(
            "roster",
            {**home, "PID": 11, "id_code": 1, "hh_b03": 2, "hh_b04": 2, "hh_b06_3a": 35},
            {**home, "PID": 12, "id_code": 2, "hh_b03": 1, "hh_b04": 1, "hh_b06_3a": 40},
            {**home, "PID": 13, "id_code": 3, "hh_b03": 1, "hh_b04": 3, "hh_b06_3a": 12, "hh_b16a": 1, "hh_b16b": 2,
             "hh_b19a": 1, "hh_b19b": 1, "hh_b18": 4, "hh_b21": 1},
            {**home, "PID": 14, "id_code": 4, "hh_b03": 2, "hh_b04": 3, "hh_b05a": 10, "hh_b16b": 98, "hh_b19a": 2,
             "hh_b18": 1, "hh_b21": 1},
            {**home, "PID": 15, "id_code": 5, "hh_b03": 2, "hh_b04": 4},
            {"y3_hhid": 2, "PID": 21, "id_code": 1, "hh_b03": 1, "hh_b04": 1, "hh_b06_3a": 17}),
        "household_id": make(
            "household_id",
            {**home, "ea_id": 7, "panelweight_2016": 2.0, "interviewdate_v1": "2016-05-01", "interviewdate_v2": "2016-08-09"},
            {"y3_hhid": 2, "ea_id": 8, "panelweight_2016": 1.0, "interviewdate_v1": "2016-05-01"}),
        "education": make(
            "education", {"PID": 11, "hh_c09": 5}, {"PID": 12, "hh_c09": 3},
            {"PID": 13, "hh_c11": 1, "hh_c12": 6, "hh_c15": None, "hh_c19a": 2, "hh_c19b": 2},
            {"PID": 14, "hh_c11": 1, "hh_c12": 4, "hh_c15": 2016, "hh_c19a": 15, "hh_c19b": 1},
            {"PID": 21, "hh_c11": 1, "hh_c12": 8, "hh_c15": 2016}),
        "health": make("health", {"PID": 13, "hh_d13": 2}),
        "labour": make("labour", {"PID": 12, "hh_e06_8a": 3}, {"PID": 99, "hh_e05": 1}),
        "follow_up": make(
            "follow_up", {"PID": 11}, {"PID": 12}, {"PID": 13, "hh_c11": 2, "hh_c13": 2, "hh_c15": 4},
            {"PID": 14, "hh_c11": 1}, {"PID": 21, "hh_c11": 1}, {"PID": 77, "hh_c11": 1}),
        "housing": make("housing", {**home, "hh_f34": 3, "hh_f36": 9}),
        "food_items": make(
            "food_items", {**home, "hh_g02": 101, "hh_g05": 30.0, "interviewDate": "##N/A##"},
            {**home, "hh_g02": 501, "hh_g05": None, "interviewDate": "##N/A##"},
            {**home, "hh_g02": 999, "hh_g05": 12.0, "interviewDate": "##N/A##"}),
        "nonfood_week": make("nonfood_week", {**home, "qx_type": 2, "hh_i03": 5.0}),
        "nonfood_month": make("nonfood_month", {**home, "qx_type": 2, "hh_i06": None}),
        "nonfood_quarter": make("nonfood_quarter", {**home, "qx_type": 2, "hh_j03": 30.0}),
        "nonfood_year": make("nonfood_year"),
        "food_days": make("food_days", {**home, **{f"hh_g08{x}": 1 for x in "bcdefghi"}}),
        "food_security": make("food_security", {**home, **{f"hh_h02{x}": 1 for x in "abcde"}}),
        "assets": make("assets", *[{"y3_hhid": h, "hh_l02": c, "hh_l01": 1 + (h * c) % 2} for h in (1, 2)
                                   for c in cs.ASSET_CODES]),
        "enterprise": make("enterprise", {**home, "hh_n01": 2}),
        "other_income": make("other_income", {**home, "hh_p02": 12.0}),
        "safety_nets": make(
            "safety_nets", {**home, "hh_r0a": 101, "hh_r02a": 100.0},
            {**home, "hh_r0a": 105, "hh_r02b": 20.0, "hh_r04a": 4, "hh_r04b": 4}),
        "wellbeing": make("wellbeing", {**home, "hh_t05": 1, "hh_t06": 2, "hh_t07": 1, "hh_t08": 5}),
        "shocks": make("shocks", {**home, "hh_u0a": 104, "hh_u02": 1}, {**home, "hh_u0a": 101, "hh_u02": 2}),
        "community_basic": make(
            "community_basic",
            {"ea_id": 7, "com_cc02": 500, "com_cc04a": 2, "com_cc04b": 10, "com_cc04c": 3, "com_cc04d": 40,
             "com_cc07a": 5, "com_cc07b": 9}),
        "community_services": make(
            "community_services", {"ea_id": 7, "com_cd01": 2, "com_cd16": 3, "com_cd16b": 2, "com_cd15": 2, "com_cd17": 1}),
        "community_economy": make("community_economy", {"ea_id": 7, "com_ce02": 1}),
        "community_changes": make("community_changes", {"ea_id": 7, "com_cg35c": 7}),
        "plots": make("plots", {**home, "gardenid": 1, "ag_d42a1": 2, "ag_d42b1": 2, "ag_d42c1": 3, "ag_d42d1": 4,
                                "ag_d42a2": 2, "ag_d42b2": 1, "ag_d42c2": 1, "ag_d42d2": None}),
        "prices": frame(spark, "int_date_hhmod string, cpi double", ("2016-05", BASE_INDEX), ("2016-08", BASE_INDEX / 2)),
    }
    return tables


def test_modelling_table(spark, village):
    children = {r.PID: r.asDict() for r in cs.child_sample(village, validate=True).collect()}
    # Child 21 lives where no community questionnaire exists; adults have no target.
    assert set(children) == {13, 14}
    left, stayed = children[13], children[14]
    assert list(left) == cs.FINAL
    assert (left["dropout"], stayed["dropout"]) == (1, 0)
    assert (left["school_travel_min"], stayed["school_travel_min"]) == (120.0, 15.0)
    # Sizes count the grandmother too: 2 adults and 2 children with a known age, 5 members.
    assert (left["total0_17"], left["num_elderly"], left["phone_per_adult"]) == (2, 1, 1.5)
    assert (left["hh_head_gender"], left["mother_presence"], stayed["mother_presence"]) == (0, 1, 0)
    # Present parents: own answers. Absent: the oldest adults seen in both waves, and the head's job.
    assert (left["father_educ_type2"], left["mother_educ_type2"], left["father_job"]) == (3, 1, 3)
    assert (stayed["father_educ_type2"], stayed["mother_educ_type2"], stayed["father_job"]) == (2, 4, 3)
    scale = 1 + 0.5 + 2 * 0.3
    # Food of May at the base price; non-food answered in August at twice that.
    assert left["total_aes1_exp_inf"] == pytest.approx((42 + 2 * (20 + 10)) / scale)
    assert left["total_assist_invalue"] == pytest.approx(120 / 12 / scale)
    assert (left["school_feed_beneficiary"], stayed["school_feed_beneficiary"]) == (0, 1)
    assert (left["food_consumption_score"], left["r_csi"]) == (16.0, 8.0)
    assert (left["cat_hh_t05"], left["wellbeing_better_neighbors"], left["wellbeing_better_friends"]) == ("1-poor", 0, 0)
    assert (left["hh_u0a_most_severe"], left["drink_water_type"], left["hh_t08_type2"]) == (104, 4, 3)
    assert (left["freq_religion"], left["freq_marriage_type2"], left["road_type"]) == (3, 2, 1)
    assert (left["com_cd16_meter"], left["com_cd18a_meter"], left["com_cd20a_meter"]) == (3000.0, 0.0, None)
    assert {left[f"asset_q{k}_recoded"] for k in range(2, 6)} <= {"Yes", "No"}


def test_member_table_keeps_what_the_modelling_table_leaves_out(spark, village):
    members = cs.member_table(village, with_assets=False)
    found = {r.PID: r for r in members.collect()}
    assert set(found) == {11, 12, 13, 14, 21}
    # Two entries of the same worker on one plot: 2*3*4 hours and an unknown one.
    assert found[12].total_rainy_labor_landprep == 24.0 and found[12].total_rainy_labor_weed is None
    assert found[13].com_shocks7 == 1 and found[13].hh_c09_mother == 5
    assert (found[11].oldest_female_hh, found[12].oldest_male_hh, found[13].oldest_male_hh) == (1, 1, None)
    assert found[13].aes1_exp_meat2 == 0.0 and found[13].aes1_exp_roots2 is None
    compat = cs.member_table(village, with_assets=False, compat=True).filter("PID = 13").first()
    assert compat.com_shocks7 == 7


def test_files_in_and_out(spark, village, tmp_path):
    for name, df in village.items():
        write_table(df, f"{tmp_path}/in/{cs.SURVEY_TABLES[name]}.parquet")
    cs.write_child_sample(spark, f"{tmp_path}/in", f"{tmp_path}/sample.parquet")
    sample = read_table(spark, f"{tmp_path}/sample.parquet")
    assert sample.columns == cs.FINAL and len(cs.FINAL) == 98
    assert caption_of(sample, "road_type") == cs.CAPTIONS["road_type"]
    labels = read_table(spark, f"{tmp_path}/sample.parquet_labels")
    coded = [c for c in VALUE_LABELS if c in cs.FINAL]
    loaded = load_labelled(sample, labels, coded, index=["y3_hhid", "PID"])
    assert rows(loaded.select("PID", "gender", "road_type", "dropout")) == [
        (13, "Male", "Asphalt/graded graveled", "Yes"), (14, "Female", "Asphalt/graded graveled", "No")]


@pytest.mark.parametrize("name", ["housing", "roster", "household_id", "prices"])
def test_repeated_key_fails(spark, village, name):
    twice = {**village, name: village[name].union(village[name])}
    with pytest.raises(Exception, match="key is not unique"):
        cs.child_sample(twice, with_assets=False).collect()


def test_written_tables_go_with_the_job(spark, village, tmp_path, monkeypatch):
    from kinfold import session

    monkeypatch.setattr(session, "shared_dir", lambda _: f"{tmp_path}/shared")
    with session.written_tables(spark):
        assert cs.child_sample(village, with_assets=False).count() == 2
        assert list((tmp_path / "shared").glob("table-*"))
    assert not list((tmp_path / "shared").glob("table-*"))


def test_captions_name_modelling_columns():
    assert set(cs.CAPTIONS) <= set(cs.FINAL)


def test_captions_of_the_member_table(spark, village, tmp_path):
    for name, df in village.items():
        write_table(df, f"{tmp_path}/in/{cs.SURVEY_TABLES[name]}.parquet")
    cs.write_member_table(spark, f"{tmp_path}/in", f"{tmp_path}/members.parquet")
    members = read_table(spark, f"{tmp_path}/members.parquet")
    described = {c for c in members.columns if caption_of(members, c)}
    # All amounts, hours, scores and values of the household have one, and no caption is left without a column but those of
    # the columns that only the modelling table has.
    assert set(cs.MEMBER_CAPTIONS) - described <= set(cs.FINAL)
    assert len(described) >= 85 and {c for c in members.columns if "exp" in c or "labor" in c} <= described
    assert members.filter("PID = 12").head().total_rainy_labor_landprep == 24.0


def test_shared_folder_is_empty_after_written_tables(spark, village, tmp_path, monkeypatch):
    from kinfold import session
    from kinfold.sources.dta import read_survey_file, write_survey_file

    monkeypatch.setattr(session, "shared_dir", lambda _: f"{tmp_path}/shared")
    with session.written_tables(spark):
        assert cs.member_table(village).count() == 5
        path = session.own_folder(spark, "survey")
        write_survey_file(village["housing"].select("y3_hhid", "hh_f34"), path)
        assert read_survey_file(spark, path).count() == 1
        assert len(list((tmp_path / "shared").iterdir())) > 3
    assert not list((tmp_path / "shared").iterdir())


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.length()) if found.apply(i).getName().startswith("shuffle_")}


def test_merge_report_needs_disk_for_one_merge_at_a_time(spark, village, tmp_path, monkeypatch):
    import time

    from kinfold import session
    from kinfold.catalog import survey

    monkeypatch.setattr(session, "shared_dir", lambda _: f"{tmp_path}/shared")
    monkeypatch.setattr(survey, "survey_tables", lambda *_: village)
    widest, read = [], session.own_folder
    # Shuffles of what is written next have not begun when its folder is named: what is there is left from earlier steps.
    monkeypatch.setattr(session, "own_folder", lambda *a: (time.sleep(0.2), widest.append(len(shuffle_files(spark) - before)), read(*a))[-1])
    before = shuffle_files(spark)
    counts = {r.merge: r for r in survey.merge_counts(spark, "").collect()}
    assert len(widest) > 6 and not any(widest)
    assert not list((tmp_path / "shared").iterdir())
    own = counts["parent_mother"]
    assert (own.base_rows, own.lookup_rows, own.matched) == (5, 5, 1) and counts["plot_hours"].base_repeats == 0
    assert list(counts)[-4:] == ["parent_father", "parent_mother", "plot_hours", "households"]


def test_member_table_in_steps(spark, village, tmp_path, monkeypatch):
    """The same members, from few and small plans; tables that later ones replace are gone."""
    from kinfold import session

    monkeypatch.setattr(session, "shared_dir", lambda _: f"{tmp_path}/shared")
    at_once = cs.member_table(village, with_assets=False)
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")
    with session.written_tables(spark):
        stepwise = cs.member_table(village, with_assets=False, in_steps=True)
        assert stepwise.schema == at_once.schema and rows(stepwise, "PID") == rows(at_once, "PID")
        # People, hours and members without hours are gone; left are sizes, communities, prices, households and members.
        left = [p for p in (tmp_path / "shared").glob("table-*")]
        assert joins(stepwise) == 1 and not any("total_rainy_labor_weed" in read_table(spark, str(p)).columns
                                                and "hh_b16b" not in read_table(spark, str(p)).columns for p in left)
        assert sum("hh_b16b" in read_table(spark, str(p)).columns for p in left) == 2  # people of the other table
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


def test_fathers_are_joined_once(spark, village):
    plan = cs.member_table(village, with_assets=False)._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Join LeftOuter" in line and "hh_b16b" in line for line in plan.splitlines()) == 1


def test_csv(spark, tmp_path):
    path = f"{tmp_path}/t.csv"
    frame(spark, "a int, b string", (1, "x")).coalesce(1).write.option("header", True).csv(path)
    assert rows(read_table(spark, path, "a int, b string")) == [(1, "x")]


def test_hot_household_does_not_change_totals(spark, village):
    """One household with most members: every member gets the household's row once."""
    base = village["roster"].filter("PID = 21")
    crowd = base.crossJoin(spark.range(2000)).withColumns(
        {"PID": F.col("id") + 1000, "id_code": (F.col("id") + 100).cast("int")}).drop("id")
    tables = {**village, "roster": village["roster"].unionByName(crowd)}
    tables["follow_up"] = village["follow_up"].unionByName(
        crowd.select("PID", F.lit(1).alias("hh_c11")), allowMissingColumns=True)
    members = cs.member_table(tables, with_assets=False)
    big = members.filter("y3_hhid = 2")
    assert big.count() == 2001
    assert big.select("total_hh_member").distinct().collect()[0][0] == 2001
