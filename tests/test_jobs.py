"""The reference's programs end to end on hand-made files in their own layouts."""

import os

from ember.plans.jobs import ratings_answers, retail_answers


def write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_ratings_job_from_text_files(spark, tmp_dir):
    d = tmp_dir
    write(f"{d}/movies.txt", ["1,Toy Story,Animation|Comedy", "2,Heat,Action", "3,Solo,Comedy"])
    write(f"{d}/ratings_1.txt", ["10,1,4.0,978307199", "11,1,5.0,978307200", "12,2,3.0,978307200", "10,9,1.0,0"])
    write(f"{d}/ratings_2.txt", ["13,1,4.0,978307200", "14,1,2.0,978307200", "10,1,4.0,978307200",
                                 "12,3,5.0,0", "x,1,oops,0"])
    write(f"{d}/users.txt", ["10,M,18,1", "11,F,19,2", "12,M,51,1", "13,F,36,2", "14,X,50,1"])
    write(f"{d}/occupation.txt", ["1,artist", "2,doctor"])
    a = ratings_answers(spark, f"{d}/movies.txt", [f"{d}/ratings_1.txt", f"{d}/ratings_2.txt"],
                        f"{d}/users.txt", f"{d}/occupation.txt")
    lines = {r["movie_id"]: r["report_line"] for r in a["movie_report"].collect()}
    assert lines["1"] == "Toy Story AverageRating: 3.80 (TotalRatings: 5)"
    assert [r["report_line"] for r in a["best_movie"].collect()] == [
        "Toy Story is the highest rated movie with an average rating of 3.80 among movies with at least 5 ratings."]
    genres = {r["genre"]: r["report_line"] for r in a["genre_report"].collect()}
    assert genres["Comedy"] == "Comedy - AverageRating: 4.00 (TotalRatings: 6)"
    g = {r["movie_id"]: r["report_line"] for r in a["gender_report"].collect()}
    assert g["1"] == "Toy Story - Male_Avg: 4.00, Female_Avg: 4.50"
    ages = {r["movie_id"]: r["report_line"] for r in a["age_report"].collect()}
    assert ages["2"] == "Heat - [0-18: NA, 18-35: NA, 35-50: NA, 50+: 3.00]"
    assert [r["report_line"] for r in a["year_report"].collect()] == [
        "1970 - TotalRatings: 2, AverageRating: 3.00", "2000 - TotalRatings: 1, AverageRating: 4.00",
        "2001 - TotalRatings: 5, AverageRating: 3.60"]
    occ = {r["occupation"]: r["report_line"] for r in a["occupation_report"].collect()}
    assert occ["doctor"] == "doctor - AverageRating: 4.50 (TotalRatings: 2)"
    assert [(r["source"], r["value"]) for r in a["quarantine"].collect()] == [("ratings", "x,1,oops,0")]


def test_retail_job_from_csv_files(spark, tmp_dir):
    d = tmp_dir
    write(f"{d}/Orders.csv", ["Order_ID;Customer_Trx_ID;Order_Purchase_Timestamp;Extra",
                              "o1;c1;2024-01-05 10:00:00;x", "o2;c1;2024-03-01 00:00:00;x",
                              "o3;c2;2023-12-31 23:59:59;x", "o4;c3;garbage;x"])
    write(f"{d}/Products.csv", ["Product_ID;Product_Category_Name", "p1;toys", "p2;books"])
    write(f"{d}/Order_Items.csv", ["Order_ID;Product_ID;seller_id;Price;Freight_Value",
                                   "o1;p1;s1;10.5;1.25", "o2;p2;s2;5.0;0.5", "o3;p1;s1;7.0;0.0", "o4;p2;s3;1.0;1.0"])
    write(f"{d}/Customer_List.csv", ["Customer_Trx_ID;Customer_Country", "c1;VN", "c2;BR", "c3;VN"])
    write(f"{d}/Order_Reviews.csv", ["Order_ID;Review_Score", "o1;5", "o1;4", "o2;1.0", "o3;3", "o4;x"])
    a = retail_answers(spark, f"{d}/Orders.csv", f"{d}/Products.csv", f"{d}/Order_Items.csv",
                       f"{d}/Customer_List.csv", f"{d}/Order_Reviews.csv")
    e = a["entity_counts"].first()
    assert (e["total_orders"], e["total_customers"], e["total_sellers"]) == (4, 3, 3)
    assert [tuple(r) for r in a["orders_by_country"].collect()] == [("VN", 3), ("BR", 1)]
    assert [tuple(r) for r in a["orders_by_month"].collect()] == [(None, None, 1), (2023, 12, 1), (2024, 3, 1),
                                                                  (2024, 1, 1)]
    assert [tuple(r) for r in a["revenue_by_category"].collect()] == [("toys", 11.75), ("books", 5.5)]
    assert a["revenue_by_category"].columns == ["category", "total_revenue_2024"]
    assert sorted(tuple(r) for r in a["top_products"].collect()) == [("p1", 3, 4.0)]
    assert sorted(r[0] for r in a["score_distinct"].collect()) == ["3", "4", "5"]


def test_frame_job_wiring_with_a_file_source(spark, tmp_dir, monkeypatch):  # C13 via the job function
    import base64
    import json

    import numpy as np

    from ember import streaming as S
    from ember.plans import jobs

    staged = f"{tmp_dir}/staged/partition=0"
    os.makedirs(staged)
    frame = np.zeros((24, 24, 3), dtype=np.uint8)
    frame[..., 1] = 255
    pk = {"camera_id": "camA", "timestamp_ms": 1, "frame_number": 3, "width": 24, "height": 24,
          "encoding": "RAW", "frame_data": base64.b64encode(frame.tobytes()).decode(), "quality": 85}
    write(f"{staged}/part-0.json", [json.dumps({"key": "camA", "value": json.dumps(pk)})])
    seen = {}

    def fake_kafka(spark_, servers, topic, **kw):
        seen.update(servers=servers, topic=topic, **kw)
        return S.file_message_source(spark_, f"{tmp_dir}/staged")

    monkeypatch.setattr(S, "kafka_source", fake_kafka)
    q = jobs.start_frame_job(spark, "broker:9092", "frames", f"{tmp_dir}/job", trigger="1 second", min_partitions=4)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert seen == {"servers": "broker:9092", "topic": "frames", "max_offsets_per_trigger": None, "min_partitions": 4}
    out = spark.read.parquet(f"{tmp_dir}/job/out").collect()
    assert [(r["filename"], r["status"]) for r in out] == [("camA_000003.png", "ok")]
