#: Counters in one aggregate: wider ones lose whole-stage code generation.
COUNTERS_PER_PASS = 40
