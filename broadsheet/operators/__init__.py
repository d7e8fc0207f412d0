"""Table operators: dedup, conforming, mutations, rankings, serving, audits, lake writes."""
