"""ledgerloom: payment reconciliation, ticket retrieval and corpus preparation as DataFrame-to-DataFrame operators."""
