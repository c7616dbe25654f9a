"""The registered queries, their SQL counterparts, and the input both are run on."""
