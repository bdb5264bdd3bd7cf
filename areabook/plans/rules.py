"""Report configuration as data: account rules, line -> driver maps, the
roll-up tree and the scorecard criteria. Jobs read these tables; nothing about
a particular line is hard-wired in the operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class AccountRule:
    """Ledger rows that feed one report line. `direct` selects the rows summed
    per area, `pool` the head-office rows that are allocated (None: same list),
    `prefix` a leading-digits match on the account number instead of a list."""
    key: str
    direct: tuple[int, ...] = ()
    pool: tuple[int, ...] | None = None
    prefix: str | None = None

    @property
    def pool_accounts(self) -> tuple[int, ...]:
        return self.direct if self.pool is None else self.pool


@dataclass(frozen=True)
class AllocLine:
    """One allocated summary line: direct + driver share x head-office pool."""
    fin_id: int
    rule: str
    driver: str
    pre_round: bool = False   # round direct and pool to cents before allocating
    post_round: bool = True   # round the allocated value to cents


@dataclass(frozen=True)
class RuleSet:
    accounts: tuple[AccountRule, ...]
    alloc_lines: tuple[AllocLine, ...]
    funding_lines: tuple[tuple[int, str], ...]
    funding_revenue: str
    rollups: tuple[tuple[int, tuple[int, ...]], ...] = field(default=())

    def rule(self, key: str) -> AccountRule:
        for r in self.accounts:
            if r.key == key:
                return r
        raise KeyError(key)


# ---------------------------------------------------------------------------
# FIXED VALUES: account lists of the reporting chart of accounts (must equal
# the source report for right results). Natural order as written there.
# ---------------------------------------------------------------------------
CHART_ACCOUNTS = (
    AccountRule("a14", (702000030002, 702000030001, 702000030102)),
    AccountRule("a17", (719000030002,)),
    AccountRule("a15", (702000030012, 702000030112), pool=(702000030012, 7020000301122)),
    AccountRule("a16", (716000000001,)),
    AccountRule("a18", (719000030003, 719000030103, 790000030003, 790000030103, 790000030004, 790000030104)),
    AccountRule("a25", (702000010001, 702000010002, 704000000001, 705000000001, 709000000001, 714000000002,
                        714000000003, 714037000001, 714000000004, 714014000001, 715000000001, 715037000001,
                        719000000001, 709000000101, 719000000101)),
    AccountRule("a26", (816000000001, 816000000002, 816000000003)),
    AccountRule("a27", (809000000002, 809000000001, 811000000001, 811000000102, 811000000002, 811014000001,
                        811037000001, 811039000001, 811041000001, 815000000001, 819000000002, 819000000003,
                        819000000001, 790000000003, 790000050101, 790000000101, 790037000001, 849000000001,
                        899000000003, 899000000002, 811000000101, 819000060001)),
    AccountRule("a29", (831000000001, 831000000002, 832000000101, 832000000001, 831000000102)),
    AccountRule("a30", prefix="85"),
    AccountRule("a31", prefix="86"),
    AccountRule("a32", prefix="87"),
    AccountRule("a9", (790000050001, 882200050001, 790000030001, 882200030001, 790000000001, 790000020101,
                       882200000001, 882200050101, 882200020101, 882200060001, 790000050101, 882200030101)),
    AccountRule("a22", (803000000001,)),
    AccountRule("a21", (802000000002, 802000000003, 802014000001, 802037000001)),
    AccountRule("a20", (801000000001, 802000000001)),
    AccountRule("dt", (702000040001, 702000040002, 703000000001, 703000000002, 703000000003, 703000000004,
                       721000000041, 721000000037, 721000000039, 721000000013, 721000000014, 721000000036,
                       723000000014, 723000000037, 821000000014, 821000000037, 821000000039, 821000000041,
                       821000000013, 821000000036, 823000000014, 823000000037, 741031000001, 741031000002,
                       841000000001, 841000000005, 841000000004, 701000000001, 701000000002, 701037000001,
                       701037000002, 701000000101)),
)
# END FIXED VALUES


def _proxy(prefix: int, digits) -> tuple[int, ...]:
    """Account `<prefix>000000000<digit>` of the test-data ledger."""
    return tuple(prefix * 10**10 + d for d in digits)


# The test tables carry proxy account codes (see FIXTURES.md §3): same rule
# shapes, including a pool list that differs from the direct list (a15) and an
# account counted by two lines (829.. in a27 and a9).
PROXY_ACCOUNTS = (
    AccountRule("a14", _proxy(81, (0, 1, 2))),
    AccountRule("a17", _proxy(81, (3,))),
    AccountRule("a15", _proxy(81, (4, 5)), pool=_proxy(81, (4,))),
    AccountRule("a16", _proxy(81, (6,))),
    AccountRule("a18", _proxy(81, (7, 8, 9))),
    AccountRule("a25", _proxy(82, (0, 1, 2, 3, 4))),
    AccountRule("a26", _proxy(82, (5, 6))),
    AccountRule("a27", _proxy(82, (7, 8, 9))),
    AccountRule("a29", _proxy(83, (0, 1, 2))),
    AccountRule("a30", prefix="85"),
    AccountRule("a31", prefix="86"),
    AccountRule("a32", prefix="87"),
    AccountRule("a9", _proxy(83, (3, 4, 5)) + _proxy(82, (9,))),
    AccountRule("a22", _proxy(83, (6,))),
    AccountRule("a21", _proxy(83, (7, 8))),
    AccountRule("a20", _proxy(83, (9,))),
    AccountRule("dt", _proxy(84, range(10))),
)

# Summary A: which driver allocates which line (order = output order).
ALLOC_LINES_A = (
    AllocLine(14, "a14", "bal_b1"),
    AllocLine(17, "a17", "bal_b1"),
    AllocLine(15, "a15", "bal_b2"),
    AllocLine(16, "a16", "cards"),
    AllocLine(18, "a18", "bal_b2_5"),
    AllocLine(25, "a25", "bal_all"),
    AllocLine(26, "a26", "bal_all"),
    AllocLine(27, "a27", "bal_all"),
    AllocLine(29, "a29", "headcount", pre_round=True, post_round=False),
    AllocLine(30, "a30", "headcount", pre_round=True, post_round=False),
    AllocLine(31, "a31", "headcount", pre_round=True, post_round=False),
    AllocLine(32, "a32", "headcount", pre_round=True, post_round=False),
    AllocLine(9, "a9", "bal_b2_5"),
)
FUNDING_LINES_A = ((22, "a22"), (21, "a21"), (20, "a20"))

# Report hierarchy of summary A, in evaluation order (parent, children).
ROLLUPS_A = (
    (4, (14, 15, 16, 17, 18)),
    # funding lines 20-22 are computed here (they read line 4)
    (5, (19, 20, 21, 22)),
    (6, (23, 24, 25, 26, 27, 28)),
    (8, (29, 30, 31, 32)),
    (7, (4, 5, 6)),
    (1, (7, 8, 9)),
)

CHART_RULES_A = RuleSet(CHART_ACCOUNTS, ALLOC_LINES_A, FUNDING_LINES_A, "dt", ROLLUPS_A)
PROXY_RULES_A = RuleSet(PROXY_ACCOUNTS, ALLOC_LINES_A, FUNDING_LINES_A, "dt", ROLLUPS_A)

# Ratios of summary A: (fin_id, numerator ids, denominator ids, zero guard
# returns 0). Numerators/denominators are summed over the listed ids.
HEADCOUNT_FIN_A = 2
CIR_FIN_A, MARGIN_FIN_A, CAPITAL_FIN_A, PER_HEAD_FIN_A = 10, 11, 12, 13
MARGIN_DEN_IDS_A = (4, 19, 23, 24, 25)

# Summary B: report line -> allocation driver (lines not listed use "ns").
B_ALLOC_LINES = (1, 2, 3, 4, 5, 12, 13, 14, 15, 16, 17, 18, 19, 20)
B_LINE_DRIVER = {1: "wo_1", 4: "wo_1", 2: "wo_2", 3: "psdn", 5: "wo_2_5", 20: "wo_2_5",
                 12: "wo", 13: "wo", 14: "wo", 15: "wo"}
B_DEFAULT_DRIVER = "ns"
B_FUNDING_LINES = (7, 8, 9)
B_FUNDING_REVENUE_LINE = 6
B_INCOME_LINES = (1, 2, 3, 4, 5)
B_HEADCOUNT_FIN = 21
B_CIR_FIN, B_MARGIN_FIN, B_CAPITAL_FIN, B_PER_HEAD_FIN, B_NPL_FIN, B_WO_FIN = 22, 23, 24, 25, 26, 27
B_TN_RANGE = (1, 15)
B_CP_RANGE = (16, 19)
B_LN_RANGE = (1, 20)
B_MARGIN_DEN_IDS = (1, 2, 3, 4, 5, 12)
B_CAPITAL_DEN_IDS = (6, 7, 8, 9)

# Scorecards. (criteria_code, source fin_id, absolute value?, method, ascending)
KPI_A_NPL_CODE = "S04"
KPI_A_AREA_CRITERIA = (("F01", 10), ("F02", 11), ("F03", 12))
KPI_B_AREA_CRITERIA = (
    ("SC04", 26, True, "rank", True),
    ("FN01", 22, True, "dense_rank", True),
    ("FN02", 23, False, "dense_rank", False),
    ("FN03", 24, False, "dense_rank", False),
    ("FN04", 25, False, "dense_rank", False),
)
KPI_B_GROUPS = ("SC", "FN")
KPI_B_OVERALL = "OV"


def chart_codes(accounts: tuple[AccountRule, ...]) -> list[int]:
    """Every account that a chart lists, and one account a prefix rule, in ascending order."""
    listed = {a for r in accounts for a in (*r.direct, *r.pool_accounts)}
    return sorted(listed | {int(r.prefix.ljust(12, "0")) + 1 for r in accounts if r.prefix is not None})


# Month the test data is reported for (48 loan months from 1995-01).
TEST_MONTH = 199812
