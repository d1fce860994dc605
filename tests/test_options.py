from rollcall.fixed_values import KIT_PICKUP_STOCK_NAMES, SHIRT_STOCK_NAMES
from rollcall.operators.options import option_answer_groups, option_answers, unnest_options


def test_groups_equal_single_passes(tables):
    view = unnest_options(tables["participant_options"])
    args = (tables["eventticketstockitems"], tables["eventticketstockitemscomplement"], tables["eventticketstock"])
    groups = {"shirts": (SHIRT_STOCK_NAMES, {"nameParsed": "shirt"}),
              "kits": (KIT_PICKUP_STOCK_NAMES, {"day": "pickup_day", "hour": "pickup_hour"})}
    got = option_answer_groups(view, *args, groups)
    for name, (names, fields) in groups.items():
        want = option_answers(view, *args, names, fields)
        assert sorted(got[name].collect()) == sorted(want.collect())
    assert sorted((r.participant_id, r.shirt) for r in got["shirts"].collect()) == [
        (1, "G"), (1, "M"), (2, "M"), (3, "P")]
    assert [(r.participant_id, r.pickup_day, r.pickup_hour) for r in got["kits"].collect()] == [(2, "sábado", "10h")]
