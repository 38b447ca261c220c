from decimal import Decimal as D


from shelflift.operators import clean, quality
from shelflift.params import Params
from shelflift.schema import SOURCE_TABLES

TX = SOURCE_TABLES["transaction_data"]
PRODUCT = SOURCE_TABLES["product"]
CAUSAL = SOURCE_TABLES["causal_data"]


def line(basket, product, quantity=1, sales="2.00", retail="-0.50", coupon="0.00", household=1, store=1, week=10):
    return (household, basket, week * 7, product, quantity, D(sales), store, retail and D(retail), 900, week,
            D(coupon), D("0.00"))


def goods(product, department="GROCERY", commodity="BREAD"):
    return (product, 1, department, "National", commodity, "RYE", "1 OZ")


def test_discounts_become_positive_and_errors_zero(frame):
    tx = frame(TX, [line(1, 1, retail="-0.50"), line(2, 1, retail="3.99"), line(3, 1, retail=None)])
    rows = clean.clean_transactions(tx, frame(PRODUCT, [goods(1)])).orderBy("basket_id").collect()
    assert [r.retail_disc for r in rows] == [D("0.50"), D("0.00"), D("0.00")]


def test_only_merchandise_that_was_sold(frame):
    products = [goods(1), goods(2, "  "), goods(3, None), goods(4, "KIOSK-GAS"), goods(5, commodity=None),
                goods(6, commodity="NO COMMODITY DESCRIPTION"), goods(7, " MISC. TRANS. ")]
    tx = [line(1, p) for p in range(1, 8)] + [line(2, 1, quantity=0), line(3, 1, sales="0.00"), line(4, 99)]
    kept = clean.clean_transactions(frame(TX, tx), frame(PRODUCT, products)).collect()
    assert [(r.basket_id, r.product_id) for r in kept] == [(1, 1)]


def test_promotions_keep_the_placement_of_either_record(frame):
    causal = frame(CAUSAL, [(1, 1, 9, "0", "A"), (1, 1, 9, "3", "0"), (1, 1, 10, "7", "0"), (1, 1, 10, "A", "0"),
                            (1, 1, 11, "0", "0"), (1, 1, 12, None, "")])
    rows = {r.week_no: r for r in clean.clean_promotions(causal).collect()}
    assert (rows[9].display, rows[9].mailer, rows[9].on_display, rows[9].in_mailer) == ("3", "A", True, True)
    assert rows[10].display == "A"
    assert not rows[11].on_display and not rows[11].in_mailer
    assert rows[12].display is None and rows[12].on_display is None and rows[12].mailer == ""


def test_any_placement_code_survives(frame):
    codes = ["10", "Ł", "\u0100", "", None, "a longer code"]
    causal = frame(CAUSAL, [(i, 1, 9, code, "0") for i, code in enumerate(codes)] + [(i, 1, 9, "0", code) for i, code in enumerate(codes)])
    rows = {r.product_id: r for r in clean.clean_promotions(causal).collect()}
    for i, code in enumerate(codes):
        want = max("0", code or "")
        assert (rows[i].display, rows[i].mailer, rows[i].on_display, rows[i].in_mailer) == (want, want, want != "0", want != "0")


def test_causal_conflicts_tell_copies_from_disagreements(frame):
    causal = frame(CAUSAL, [(1, 1, 9, "0", "A"), (1, 1, 9, "3", "0"), (2, 1, 9, "0", "A"), (2, 1, 9, "0", "A"),
                            (3, 1, 9, "0", None)])
    assert tuple(quality.dq_causal_conflicts(causal).first()) == (2, 1, 1)


def test_duplicates_with_nulls_are_counted(frame):
    coupon = frame(SOURCE_TABLES["coupon"], [(1, None, 1), (1, None, 1), (1, 2, 1)])
    assert quality.dq_report({"coupon": coupon}, ["dq_dup_coupon"]).first().result == "1"


def test_weekly_sales_flag_tracked_weeks(frame):
    promotions = clean.clean_promotions(frame(CAUSAL, [(1, 1, 10, "3", "0")]))
    tx = frame(TX, [line(1, 1), line(2, 1, household=2), line(3, 1, week=8), line(4, 1, store=2)])
    weekly = clean.weekly_product_store_sales(
        tx, frame(PRODUCT, [goods(1)]), promotions, clean.promo_stores(promotions), Params())
    rows = {(r.store_id, r.week_no): r for r in weekly.collect()}
    assert rows[1, 10].sales == D("4.00") and rows[1, 10].households == 2 and rows[1, 10].on_display
    assert rows[1, 10].promo_tracked and not rows[1, 8].promo_tracked and not rows[2, 10].promo_tracked


def test_campaign_without_households_has_zero_reach(frame):
    desc = frame(SOURCE_TABLES["campaign_desc"], [("TypeA", 1, 224, 263), ("TypeB", 2, 300, 300)])
    targets = frame(SOURCE_TABLES["campaign_table"], [("TypeA", 5, 1)])
    rows = {r.campaign: r for r in clean.campaigns(desc, targets).collect()}
    assert (rows[1].households_targeted, rows[2].households_targeted) == (1, 0)
    assert (rows[1].length_days, rows[2].length_days) == (40, 1)
