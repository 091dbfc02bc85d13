"""Tandem: outcome modelling on mixed text and tabular records, as Spark jobs."""
