"""Shared command-line handling."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable

from ..session import get_spark, remove_scratch, shared_folder

log = logging.getLogger(__name__)


def parser(description: str) -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description=description, formatter_class=argparse.ArgumentDefaultsHelpFormatter)
    out.add_argument("--log-level", default="INFO", choices=["DEBUG", "INFO", "WARNING", "ERROR"])
    return out


def run(name: str, args: argparse.Namespace, body: Callable) -> int:
    """Run a job; 0 on success, 1 with a logged reason on failure."""
    logging.basicConfig(level=getattr(logging, args.log_level), format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = get_spark(name)
    shared_folder(spark)
    try:
        body(spark, args)
        return 0
    except FileNotFoundError as e:
        log.error("%s failed: %s", name, e)
    except Exception:
        log.exception("%s failed", name)
    finally:
        remove_scratch(spark)
    return 1
