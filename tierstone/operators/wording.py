"""Sentences that the reports must give word for word."""

# Fixed values, all of them.
ROWS_PASS = "LEVEL2-1 PASS ✓"
ROWS_FAIL = "LEVEL2-1 FAIL ✗  delta="
UNIQUE_PASS = "LEVEL2-2 PASS ✓ (no duplicate trade_id)"
UNIQUE_FAIL = "LEVEL2-2 FAIL ✗  duplicates found: "
SUMS_PASS = "LEVEL3-1 PASS ✓"
SUMS_FAIL = "LEVEL3-1 FAIL ✗"
NULLS_PASS = "LEVEL3-2 PASS ✓"
NULLS_FAIL = "LEVEL3-2 FAIL ✗  unexpected NULLs in NOT NULL columns"
SAMPLE_FAIL = "LEVEL5 FAIL ✗  Hash or row mismatches detected"
SAMPLE_PASS_BEFORE = "LEVEL5 PASS ✓  All "
SAMPLE_PASS_AFTER = " sampled rows match"
SIGN_OFF_BEFORE = "Validation complete for partition "
SIGN_OFF_AFTER = ". Review all individual PASS/FAIL results above before proceeding."
SOURCE_PASS = "CHECK-4 PASS ✓  Source table has data"
SOURCE_FAIL = "CHECK-4 FAIL ✗  Source table is empty — check table name"
COPIES_PASS = "CHECK-5 PASS ✓  No duplicate trade_id"
COPIES_FAIL_BEFORE = "CHECK-5 FAIL ✗  Duplicates: "
COPIES_FAIL_AFTER = " — fix before migrating"
