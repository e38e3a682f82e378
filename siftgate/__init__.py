"""siftgate: declarative data-quality analytics on Spark DataFrames."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from siftgate.operators.group_checks import group_check, group_rule_set
from siftgate.operators.row_checks import row_check, row_rule_set
from siftgate.plans.rules import Rule, RuleError, RuleSet, load_rules

__all__ = ["Rule", "RuleError", "RuleSet", "load_rules", "row_check", "group_check",
           "row_rule_set", "group_rule_set"]

# Page helpers travel with the tasks, so executors need no installation of this package.
register_pickle_by_value(sys.modules[__name__])
