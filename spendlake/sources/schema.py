"""The declared billing table: 125 data columns and four partition keys."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Data columns in table order, name and type.
CUR_COLUMNS = """
bill_bill_type string
bill_billing_entity string
bill_billing_period_end_date timestamp
bill_billing_period_start_date timestamp
bill_invoice_id string
bill_payer_account_id string
bill_payer_account_name string
cost_category map<string,string>
discount map<string,double>
identity_line_item_id string
identity_time_interval string
line_item_availability_zone string
line_item_legal_entity string
line_item_line_item_description string
line_item_line_item_type string
line_item_operation string
line_item_product_code string
line_item_resource_id string
line_item_unblended_cost double
line_item_usage_account_id string
line_item_usage_account_name string
line_item_usage_amount double
line_item_usage_end_date timestamp
line_item_usage_start_date timestamp
line_item_usage_type string
pricing_lease_contract_length string
pricing_offering_class string
pricing_public_on_demand_cost double
pricing_purchase_option string
pricing_term string
pricing_unit string
product map<string,string>
product_from_location string
product_instance_type string
product_product_family string
product_servicecode string
product_to_location string
reservation_amortized_upfront_fee_for_billing_period double
reservation_effective_cost double
reservation_end_time string
reservation_reservation_a_r_n string
reservation_start_time string
reservation_unused_amortized_upfront_fee_for_billing_period double
reservation_unused_recurring_fee double
resource_tags map<string,string>
savings_plan_amortized_upfront_commitment_for_billing_period double
savings_plan_end_time string
savings_plan_offering_type string
savings_plan_payment_option string
savings_plan_purchase_term string
savings_plan_savings_plan_a_r_n string
savings_plan_savings_plan_effective_cost double
savings_plan_start_time string
savings_plan_total_commitment_to_date double
savings_plan_used_commitment double
split_line_item_parent_resource_id string
split_line_item_reserved_usage double
split_line_item_actual_usage double
split_line_item_split_usage double
split_line_item_split_usage_ratio double
split_line_item_split_cost double
split_line_item_unused_cost double
split_line_item_net_split_cost double
split_line_item_net_unused_cost double
split_line_item_public_on_demand_split_cost double
split_line_item_public_on_demand_unused_cost double
bill_invoicing_entity string
discount_bundled_discount double
discount_total_discount double
line_item_blended_cost double
line_item_blended_rate string
line_item_currency_code string
line_item_net_unblended_cost double
line_item_net_unblended_rate string
line_item_normalization_factor double
line_item_normalized_usage_amount double
line_item_tax_type string
line_item_unblended_rate string
pricing_currency string
pricing_public_on_demand_rate string
pricing_rate_code string
pricing_rate_id string
product_comment string
product_fee_code string
product_fee_description string
product_from_location_type string
product_from_region_code string
product_instance_family string
product_instancesku string
product_location string
product_location_type string
product_operation string
product_pricing_unit string
product_region_code string
product_sku string
product_to_location_type string
product_to_region_code string
product_usagetype string
reservation_amortized_upfront_cost_for_usage double
reservation_availability_zone string
reservation_modification_status string
reservation_net_amortized_upfront_cost_for_usage double
reservation_net_amortized_upfront_fee_for_billing_period double
reservation_net_effective_cost double
reservation_net_recurring_fee_for_usage double
reservation_net_unused_amortized_upfront_fee_for_billing_period double
reservation_net_unused_recurring_fee double
reservation_net_upfront_value double
reservation_normalized_units_per_reservation string
reservation_number_of_reservations string
reservation_recurring_fee_for_usage double
reservation_subscription_id string
reservation_total_reserved_normalized_units string
reservation_total_reserved_units string
reservation_units_per_reservation string
reservation_unused_normalized_unit_quantity double
reservation_unused_quantity double
reservation_upfront_value double
savings_plan_instance_type_family string
savings_plan_net_amortized_upfront_commitment_for_billing_period double
savings_plan_net_recurring_commitment_for_billing_period double
savings_plan_net_savings_plan_effective_cost double
savings_plan_recurring_commitment_for_billing_period double
savings_plan_region string
savings_plan_savings_plan_rate double
"""

# Partition keys in table order, all text.
PARTITION_KEYS = ("source_account_id", "report_name", "data", "billing_period")

# Names a catalogue crawler gives to the same keys.
PARTITION_ALIASES = ("id", "partition_1", "partition_2", "billing_period")

# Billing times are UTC wall clock, hence timestamps without zone.
_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
    "map<string,double>": T.MapType(T.StringType(), T.DoubleType()),
}


def _field(name: str, type_name: str) -> T.StructField:
    if type_name not in _TYPES:
        raise ValueError(f"column {name}: unknown type {type_name!r}")
    return T.StructField(name, _TYPES[type_name])


def cur_schema(
    partitions: bool = False, keys: tuple[str, ...] = PARTITION_KEYS
) -> T.StructType:
    """The declared schema; partition keys last, as text, when asked for.

    Keys are declared because inference would turn ``202506`` into a number.
    """
    fields = [_field(*line.split()) for line in CUR_COLUMNS.strip().splitlines()]
    if partitions:
        fields += [T.StructField(k, T.StringType()) for k in keys]
    return T.StructType(fields)


def from_json_list(text: str) -> tuple[T.StructType, list[str]]:
    """Schema from a JSON list of ``{"Name", "Type", "PartitionKey"?}`` entries.

    Returns the whole schema, partition keys last, and the names of those keys.
    """
    data, keys = [], []
    for entry in json.loads(text):
        (keys if "PartitionKey" in entry else data).append(_field(entry["Name"], entry["Type"]))
    return T.StructType(data + keys), [f.name for f in keys]


def to_json_list(schema: T.StructType, partitions: tuple[str, ...] = ()) -> str:
    """The JSON list form of a schema of the same types."""
    names = {t: n for n, t in _TYPES.items()}
    entries = []
    for f in schema.fields:
        entry = {"Name": f.name, "Type": names[f.dataType]}
        if f.name in partitions:
            entry["PartitionKey"] = f"Partition ({partitions.index(f.name)})"
        entries.append(entry)
    return json.dumps(entries)
