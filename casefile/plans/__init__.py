from casefile.plans.clean import run_eda  # noqa: F401
from casefile.plans.cluster import run_full_analysis, run_quick_demo, run_simple_analysis, run_unsupervised  # noqa: F401
from casefile.plans.forecast import run_timeseries  # noqa: F401
from casefile.plans.train import quick_compare, quick_demo, quick_train  # noqa: F401
