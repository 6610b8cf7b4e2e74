"""demandloom - monthly demand analytics and forecasting as Spark jobs."""
