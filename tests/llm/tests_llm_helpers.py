"""Plain versions that more than one test file uses."""

from test_decontam import brute as brute_decontam  # noqa: F401
from test_mixing import shared_out  # noqa: F401
from test_quality_lm import Plain  # noqa: F401
from test_simhash import groups_of, plain_fp  # noqa: F401
