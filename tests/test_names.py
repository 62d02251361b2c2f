import random

from vetmill.operators import names


def test_contained_like_brute_force(spark):
    rng = random.Random(2)
    make = lambda n: {" ".join(sorted(rng.sample("abcdefgh", rng.choice([0, 1, 2, 2, 3, 4])) + ["lee"] * rng.randint(0, 1))).strip() for _ in range(n)}
    few, many = make(60), make(60)
    frame = lambda s: spark.createDataFrame([(k, k.split()) for k in s], "key string, words array<string>")
    want = sorted((a, b) for a in few for b in many if a and set(a.split()) <= set(b.split()))
    for part in (3, 1000):
        assert sorted(map(tuple, names.contained(frame(few), frame(many), part).collect())) == want
    assert want


def test_owners_by_part_of_a_name(spark):
    accounts = [("a1", "Ann B. Lee", "1"), ("a2", "Lee, Ann", "2"), ("a3", "ann lee", "3"), ("a4", "Bo Ray Fox", "4"), ("a5", "Bo Max Fox", None), ("a6", "Cher", "6"), ("a7", "", "7"), ("a8", None, "8"), ("a9", "Bo Ray Fox", "9")]
    accounts = spark.createDataFrame(accounts, "account_id string, display_name string, primary_phone string")
    src = [(1, "ANN  Lee", ""), (2, "Lee Ann", "2"), (3, "Ann Lee B", None), (4, "fox bo", "4"), (5, "fox bo", None), (6, "Cher", "1"), (7, "Cher Bono", ""), (8, " ", "7"), (9, None, None), (10, "Ann Kim Lee", "3"), (11, "Bo Ray Fox", "9"), (11, "Bo Ray Fox", "9")]
    src = spark.createDataFrame(src, "src_id long, client_name string, phone_no string")
    got = sorted(map(tuple, names.owners_by_part(src, accounts).collect()))
    assert got == [(1, "exact", 1, "a3"), (2, "words", 1, "a2"), (3, "words", 1, "a1"), (4, "part", 1, "a4"), (5, "part", 3, None), (6, "exact", 1, "a6"),
                   (10, "part", 1, "a3"), (11, "exact", 1, "a9"), (11, "exact", 1, "a9")]
    assert names.owners_by_part(src, accounts.limit(0)).count() == 0 and names.owners_by_part(src.limit(0), accounts).count() == 0
