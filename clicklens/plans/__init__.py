"""The jobs: enhance a log, build dashboard and explore tables, extract a schedule."""
