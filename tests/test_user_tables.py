"""Guarded user tables: limits, all-or-nothing batches, serial ids, truncation."""

import pytest

from nestrel.plans import user_tables as U


@pytest.mark.parametrize("limit", [1, 3])
def test_a_batch_that_would_pass_the_limit_changes_nothing(spark, scratch, limit):
    base = f"{scratch}/limits"
    U.create(spark, base)
    full = [(700 + i, None if i % 2 else 90 + i) for i in range(limit)]
    assert not U.insert_roster(spark, base, [*full, (800, 1)], max_rows=limit)
    assert U.roster(spark, base).count() == 0
    assert U.insert_roster(spark, base, full, max_rows=limit)
    assert sorted(x.poke_id for x in U.roster(spark, base).collect()) == [x for x, _ in full]
    assert not U.insert_roster(spark, base, [(801, None)], max_rows=limit)
    assert [x.id for x in U.roster(spark, base).orderBy("id").collect()] == list(range(1, limit + 1))


def test_equal_rows_get_ids_of_their_own(spark, scratch):
    base = f"{scratch}/equal"
    U.create(spark, base)
    assert U.insert_roster(spark, base, [(512, None), (512, None)])
    assert U.insert_roster(spark, base, [(512, 8)])
    assert sorted(x.id for x in U.roster(spark, base).collect()) == [1, 2, 3]


def test_truncation_empties_the_items_and_starts_ids_anew(spark, scratch):
    base = f"{scratch}/cut"
    U.create(spark, base)
    U.insert_roster(spark, base, [(220, 5), (221, 6)])
    assert U.insert_items(spark, base, [(2, 71), (2, 72)])
    U.truncate_roster(spark, base)
    assert U.items(spark, base).count() == 0
    U.insert_roster(spark, base, [(333, None)])
    assert [(x.id, x.poke_id) for x in U.roster(spark, base).collect()] == [(1, 333)]


def test_orphans_are_counted_per_key(spark, scratch):
    base = f"{scratch}/orphans"
    U.create(spark, base)
    U.insert_roster(spark, base, [(150, None), (151, 44), (152, 45)])
    U.insert_items(spark, base, [(3, 9), (40, 9), (41, 10)])
    known = spark.createDataFrame([(150,), (152,)], "id int")
    skills = spark.createDataFrame([(45,)], "id int")
    moves = spark.createDataFrame([(9,)], "id int")
    got = {r.fk: r.orphans for r in U.check(spark, base, known, skills, moves).collect()}
    assert got == {"trainer.poke_id": 1, "trainer.ability_id": 1,
                   "trainer_moves.trainer_id": 2, "trainer_moves.move_id": 1}
