"""perkflow: employee-benefit analytics as Spark DataFrame operators.

Main entry points (each a DataFrame -> DataFrame function):

    operators.eligibility.employee_eligibility   gold table (bonus, well-being days, costs)
    operators.refine.employees_silver            refined employees with commute distance
    operators.refine.activities_silver           refined activities with pace
    operators.enrichment.resolve_addresses       distance lookup per distinct address
    operators.cdc.parse_messages / current_state change-stream parsing and state
    operators.lookup.with_messages               notification wording + dead letters
    operators.quality.run_suite / summarize      data-quality rules as tables
    operators.kpis.program_kpis                  programme indicators
    plans.medallion.run_daily                    bronze >> silver >> gold for one day
    streaming.notifier.start_notifier            live notifications (Structured Streaming)
    streaming.current_state.start_state_stream   current state from a change stream
"""

__version__ = "0.1.0"
