"""Tables of a Stripe account. Every object has the same head, key, cursor and mode."""

from tidemark.model import CDC, TableDef
from tidemark.sources.catalog.fields import fields

# Columns of each table after the common head `id object created`.
# `json` marks a nested object kept as JSON text.
_HEAD = "id! object created:long "
_COLUMNS = {
    "customers": """updated:long livemode:boolean email name phone description address_line1
        address_line2 address_city address_state address_postal_code address_country shipping_name
        shipping_phone shipping_address_line1 shipping_address_line2 shipping_address_city
        shipping_address_state shipping_address_postal_code shipping_address_country balance:long currency
        delinquent:boolean preferred_locales:[string] invoice_settings:json tax_exempt default_source
        invoice_prefix metadata:json discount:json deleted:boolean""",
    "charges": """livemode:boolean amount:long amount_captured:long amount_refunded:long currency status
        paid:boolean refunded:boolean captured:boolean disputed:boolean customer invoice payment_intent
        payment_method description receipt_email receipt_url statement_descriptor billing_details:json
        payment_method_details:json outcome:json metadata:json failure_code failure_message""",
    "payment_intents": """livemode:boolean amount:long amount_capturable:long amount_received:long currency
        status canceled_at:long cancellation_reason customer invoice payment_method description
        receipt_email statement_descriptor capture_method confirmation_method charges:json
        payment_method_options:json shipping:json metadata:json latest_charge""",
    "subscriptions": """livemode:boolean status current_period_start:long current_period_end:long
        cancel_at:long canceled_at:long ended_at:long trial_start:long trial_end:long customer
        default_payment_method latest_invoice billing_cycle_anchor:long collection_method
        days_until_due:long items:json metadata:json discount:json cancel_at_period_end:boolean""",
    "invoices": """livemode:boolean status paid:boolean amount_due:long amount_paid:long
        amount_remaining:long total:long subtotal:long tax:long currency customer subscription charge
        payment_intent billing_reason collection_method customer_email customer_name due_date:long
        period_start:long period_end:long number hosted_invoice_url invoice_pdf lines:json metadata:json""",
    "products": """updated:long livemode:boolean name description active:boolean type unit_label url
        images:[string] metadata:json statement_descriptor tax_code shippable:boolean deleted:boolean""",
    "prices": """livemode:boolean active:boolean currency unit_amount:long unit_amount_decimal product
        billing_scheme type recurring:json lookup_key nickname tax_behavior tiers:json tiers_mode
        metadata:json""",
    "refunds": """livemode:boolean amount:long currency charge payment_intent status reason receipt_number
        metadata:json failure_reason""",
    "disputes": """livemode:boolean amount:long currency charge payment_intent status reason evidence:json
        evidence_details:json is_charge_refundable:boolean metadata:json""",
    "payment_methods": """livemode:boolean type customer billing_details:json card:json
        us_bank_account:json metadata:json""",
    "balance_transactions": """livemode:boolean amount:long currency net:long fee:long fee_details:json
        type source status description available_on:long exchange_rate""",
    "payouts": """livemode:boolean amount:long currency arrival_date:long status type method destination
        description balance_transaction failure_code failure_message metadata:json""",
    "invoice_items": """livemode:boolean amount:long currency customer invoice subscription price
        description quantity:long unit_amount:long unit_amount_decimal period_start:long period_end:long
        discounts:json metadata:json""",
    "plans": """livemode:boolean active:boolean amount:long currency interval interval_count:long product
        nickname usage_type aggregate_usage trial_period_days:long tiers:json tiers_mode metadata:json
        deleted:boolean""",
    "events": "livemode:boolean type data:json api_version request:json pending_webhooks:long",
    "coupons": """livemode:boolean name amount_off:long percent_off currency duration
        duration_in_months:long max_redemptions:long times_redeemed:long redeem_by:long valid:boolean
        applies_to:json metadata:json""",
}
_FALSY_TEXT = {"balance_transactions": ("exchange_rate",), "coupons": ("percent_off",)}
_ADDRESS = ("line1", "line2", "city", "state", "postal_code", "country")
_PATHS = {
    "customers": {f"address_{part}": f"address.{part}" for part in _ADDRESS}
    | {f"shipping_{part}": f"shipping.{part}" for part in ("name", "phone")}
    | {f"shipping_address_{part}": f"shipping.address.{part}" for part in _ADDRESS},
    "invoice_items": {"period_start": "period.start", "period_end": "period.end"},
}


def _table(name: str, columns: str) -> TableDef:
    words = columns.split()
    schema = fields(_HEAD + columns.replace(":json", ""))
    return TableDef(
        name,
        schema,
        keys=("id",),
        cursor="created",
        mode=CDC,
        paths=_PATHS.get(name, {}),
        json_text=tuple(w.removesuffix(":json") for w in words if w.endswith(":json")),
        falsy_text=_FALSY_TEXT.get(name, ()),
        defaults={"deleted": False} if "deleted" in schema.fieldNames() else {},
        envelope="data",
    )


TABLES = {name: _table(name, columns) for name, columns in _COLUMNS.items()}
