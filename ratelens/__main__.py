"""``python -m ratelens {business,regression,classification} --data DIR --output DIR``"""

from __future__ import annotations

import argparse

from ratelens.plans.pipelines import run_business, run_classification, run_regression
from ratelens.session import build_session

FLOWS = {"business": run_business, "regression": run_regression, "classification": run_classification}

if __name__ == "__main__":
    parser = argparse.ArgumentParser(prog="ratelens")
    parser.add_argument("flow", choices=FLOWS)
    parser.add_argument("--data", required=True, help="folder of the CSV inputs")
    parser.add_argument("--output", required=True, help="folder for tables, models and results")
    arguments = parser.parse_args()
    session = build_session()
    try:
        FLOWS[arguments.flow](session, arguments.data, arguments.output)
    finally:
        session.stop()
