"""Verbatim copies and siblings of benchmark items."""

from fixtures import documents

from tutorlake.llm import templates

OWN = "the wind over the hills was calm and nobody had seen a bird since early spring when the river rose again quickly"


def _found(spark, items, rows):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return templates.contaminated(documents(spark, [(i, t, "s") for i, t in rows]), benchmark).collect()


def test_verbatim_copies_need_no_plain_words(spark):
    items = [(1, "Add 12 34 56 78 91 23 45 67 89 10 11 13 14 15 16 17 now"), (2, "Great Fires Of Northern Towns And Their Slow Causes Through Six Long Ages"),
             (3, "Name four moons"), (4, "Describe the causes of the long war between both towns")]
    rows = [(i, f"{OWN} {text} {OWN}") for i, text in items] + [(9, OWN), (10, f"{OWN} add 12 34 56 78 90 23 45 67 89 10 11 13 14 99 16 17")]
    found = _found(spark, items, rows)
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 2), (3, 3), (4, 4)}
    assert all(r.verbatim for r in found)
    whole = next(r for r in found if r.doc_id == 4)
    assert (whole.n_windows, whole.first_word, whole.last_word) == (1, len(OWN.split()), len(OWN.split()) + 9)


ITEM = ("A train leaves the northern station with 48 passengers and after 3 hours it has carried Alice over 210 km "
        "through the valley to the old harbour, where 48 others wait for the next departure.")


def test_every_sibling_is_compared(spark):
    sibling = ITEM.replace("48 others", "61 others")
    changed = sibling.replace("48", "52").replace("61", "70").replace(" 3 ", " 5 ").replace("210", "300")
    found = _found(spark, [(1, ITEM), (2, sibling), (3, sibling)], [(1, f"{OWN} {ITEM}"), (2, f"{OWN} {sibling} {OWN}"), (3, f"{OWN} {changed}")])
    assert {(r.doc_id, r.item_id): r.verbatim for r in found} == {(1, 1): True, (1, 2): False, (2, 1): False, (2, 2): True, (3, 2): False}
    whole = next(r for r in found if (r.doc_id, r.item_id) == (2, 2))
    assert whole.n_windows == len(ITEM.split()) - templates.WIDTH + 1
    assert whole.last_word == len(OWN.split()) + len(ITEM.split()) - 1


def test_siblings_whose_shared_value_stands_for_two(spark):
    before, after = "how many of the {} boxes did the old carrier bring up that day", "and then how many of these {} boxes were left at the gate"
    items = [(1, f"{before} {after}".format(40, 40)), (2, f"{before} {after}".format(40, 55))]
    found = _found(spark, items, [(7, f"{OWN} {before} {after}".format(81, 93)), (8, f"{OWN} {before} {after}".format(81, 81))])
    assert {(r.doc_id, r.item_id) for r in found} >= {(7, 2), (8, 1)}
    assert not any(r.verbatim for r in found)


def test_items_dense_in_slots_are_matched_as_a_whole(spark):
    items = [(1, "Add 12 34 56 78 91 23 45 67 89 10 11 13 14 15 16 17 now"),
             (2, "On Monday Carla Rossi paid 45 euros and Marco Bianchi paid 32 euros"), (3, "12 34 56 78 91 23 45 67 89 10 11 13 14 15")]
    other = "Add 21 43 65 87 19 32 54 79 98 71 72 73 74 75 76 77 now"
    rows = [(1, f"{OWN}. {other} {OWN}"), (2, f"{OWN}. On Friday Paula Verdi paid 81 euros and Dario Neri paid 19 euros {OWN}"),
            (3, f"{OWN}. {other[:-4]} {OWN}"), (4, f"{OWN}. {other.replace('77', '21')} {OWN}"),
            (5, f"{OWN}. On Friday Paula Verdi paid 81 euros and Dario Neri owed 19 euros {OWN}"),
            (6, " ".join(str(n) for n in range(300, 400)))]
    found = _found(spark, items, rows)
    # 3 lacks the last word; 4 gives the last number the first one's value, more than a window away; 6 is numbers only
    assert {(r.doc_id, r.item_id, r.verbatim) for r in found} == {(1, 1, False), (2, 2, False), (4, 1, False)}
