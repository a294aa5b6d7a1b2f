from laborscope.plans.dataset import KEY, JobDataset  # noqa: F401
from laborscope.plans.job_market import (  # noqa: F401
    QUERIES,
    Report,
    labelled_postings,
    run_query,
    skills_by_type,
)
