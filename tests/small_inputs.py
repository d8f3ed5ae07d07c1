"""Small transfers and their catalog, written for these tests."""

from basketlens.plans.catalog import Catalog

M = "Town"
T = "Town.Plan"


def _cls(topic, name, kind, seq, abstract=False, base=None):
    fqn = f"{M}.{topic}.{name}" if topic else f"{M}.{name}"
    return (M, topic, name, fqn, kind, abstract, base, seq)


def prop(owner, name, seq, value_kind="String", kind="ATTRIBUTE", mandatory=False, cmin=0, cmax=1, target=None,
         lo=None, hi=None, max_len=None, enum=None, transient=False, type_name=None):
    return (owner, name, kind, value_kind, type_name or f"{value_kind}Type", mandatory, cmin, cmax, transient, False,
            target, None if lo is None else float(lo), None if hi is None else float(hi), max_len, enum, seq)


def geom(owner, name, kind, dimension=2, overlap=None, forms=("STRAIGHTS",), custom=False, line_attrs=False):
    return (owner, name, kind, f"{M}.Coord{dimension}", dimension, overlap, list(forms), custom, line_attrs)


def town_catalog(spark):
    classes = [
        _cls("", "Address", "STRUCTURE", 1),
        _cls("", "Label", "STRUCTURE", 2),
        _cls("Plan", "Thing", "CLASS", 3, abstract=True),
        _cls("Plan", "House", "CLASS", 4, base=f"{T}.Thing"),
        _cls("Plan", "Owner", "CLASS", 5),
        _cls("Plan", "Owns", "ASSOCIATION", 6),
        _cls("Plan", "Shape", "CLASS", 7),
        _cls("Notes", "Owner", "CLASS", 8),
    ]
    h, o, w, s = f"{T}.House", f"{T}.Owner", f"{T}.Owns", f"{T}.Shape"
    properties = [
        prop(f"{M}.Address", "Street", 1, max_len=30),
        prop(f"{M}.Address", "Zip", 2, "Integer", lo=1000, hi=9999),
        prop(f"{M}.Label", "Text", 1),
        prop(f"{T}.Thing", "Name", 1, mandatory=True, cmin=1, max_len=10),
        prop(h, "State", 1, "Enumeration", enum=["planned", "built"]),
        prop(h, "Labels", 2, "Structure", cmax=None, target=f"{M}.Label"),
        prop(h, "Point", 3, "Geometry"),
        prop(h, "Built", 4, "Date"),
        prop(h, "Height", 5, "Double", lo=0.0, hi=100.0),
        prop(h, "holder", 6, "Reference", kind="ROLE", target=o),
        prop(h, "Place", 7, "Structure", target=f"{M}.Address"),
        prop(h, "Line", 8, "Geometry"),
        prop(h, "Floors", 9, "Integer", lo=0, hi=100),
        prop(h, "Heated", 10, "Boolean"),
        prop(o, "Name", 1, mandatory=True, cmin=1),
        prop(w, "Share", 1, "Integer", lo=0, hi=100),
        prop(w, "owner", 2, "Reference", kind="ROLE", target=o, mandatory=True, cmin=1),
        prop(w, "house", 3, "Reference", kind="ROLE", target=h, mandatory=True, cmin=1),
        prop(s, "Curve", 1, "Geometry"),
        prop(s, "Lines", 2, "Geometry"),
        prop(s, "Spots", 3, "Geometry"),
        prop(s, "Face", 4, "Geometry"),
        prop(s, "Faces", 5, "Geometry"),
        prop(s, "Peak", 6, "Geometry"),
        prop(f"{M}.Notes.Owner", "Name", 1),
    ]
    geometry = [
        geom(h, "Line", "POLYLINE"),
        geom(h, "Point", "COORD"),
        geom(s, "Curve", "POLYLINE", overlap="0.001", forms=("STRAIGHTS", "ARCS")),
        geom(s, "Lines", "MULTIPOLYLINE"),
        geom(s, "Spots", "MULTICOORD"),
        geom(s, "Face", "SURFACE"),
        geom(s, "Faces", "MULTIAREA"),
        geom(s, "Peak", "COORD", 3),
    ]
    models = [(M, "1", "https://example.invalid", "en", "2.3", 1)]
    return Catalog.from_rows(spark, models, classes, properties, geometry, crs_map=f"{M}.Coord2=EPSG:2056")


HEAD = ('<?xml version="1.0" encoding="UTF-8"?>\n<TRANSFER xmlns="urn:t"><HEADERSECTION VERSION="2.3" SENDER="x">'
        '<MODELS><MODEL NAME="Town"/></MODELS></HEADERSECTION><DATASECTION>\n')
FOOT = "\n</DATASECTION></TRANSFER>\n"


def v23(body):
    return HEAD + body + FOOT


def plan(bid, *objects):
    return f'<{T} BID="{bid}">\n' + "\n".join(objects) + f"\n</{T}>\n"


def obj(name, tid=None, body="", operation=None, topic=T):
    attrs = (f' TID="{tid}"' if tid else "") + (f' OPERATION="{operation}"' if operation else "")
    return f"<{topic}.{name}{attrs}>{body}</{topic}.{name}>"


HOUSE1 = obj("House", "h1", """<Name>mill &amp; barn</Name><State>built</State>
<Labels><Town.Label><Text>north gate</Text></Town.Label></Labels><Labels><Town.Label><Text>listed</Text></Town.Label></Labels>
<Point><COORD><C1>612.5</C1><C2>88.25</C2></COORD></Point><Built>2020-02-29</Built><Height>11.75</Height><holder REF="o1"/>
<Place><Town.Address><Street>Lane &lt;1&gt;</Street><Zip>4500</Zip></Town.Address></Place>
<Line><POLYLINE><COORD><C1>612.5</C1><C2>88.25</C2></COORD><COORD><C1>615</C1><C2>91</C2></COORD><COORD><C1>619.5</C1>
<C2>90.75</C2></COORD></POLYLINE></Line><Floors>3</Floors><Heated>false</Heated>""")
HOUSE2 = obj("House", "h2", "<Name></Name>"
             "<Labels><Town.Label><Text>a</Text></Town.Label><Town.Label/></Labels><Floors>16</Floors><Heated>true</Heated>")
HOUSE3 = f'<{T}.House TID="h3" OPERATION="DELETE"/>'
OWNERS = obj("Owner", "o1", "<Name>Ann</Name>") + obj("Owner", "o2", "<Name>Bo</Name>")
LINKS = (obj("Owns", body='<owner REF="o1"/><house REF="h1"/><Share>60</Share>')
         + obj("Owns", body='<owner REF="o2"/><house REF="h1"/><Share>40</Share>')
         + obj("Owns", body='<owner REF="o2"/><house REF="h2"/><Share>100</Share>'))
NOTES = '<Town.Notes BID="n"><Town.Notes.Owner TID="o1"><Name>other</Name></Town.Notes.Owner></Town.Notes>'

TOWN = v23("<!-- <Town.Plan.House TID='never'/> -->" + plan("b1", HOUSE1, HOUSE2, HOUSE3, OWNERS)
           + plan("b2", LINKS) + NOTES)

TOWN24 = """<?xml version="1.0" encoding="UTF-8"?>
<ili:transfer xmlns:ili="urn:i" xmlns:Town="urn:town" xmlns:geom="urn:g">
<ili:headersection><ili:models><ili:model>Town</ili:model></ili:models></ili:headersection>
<ili:datasection>
<Town:Plan ili:bid="b24">
<Town:House ili:tid="h24"><Town:Name>tower</Town:Name><Town:State>planned</Town:State>
<Town:Labels><Town:Label><Town:Text>x</Town:Text></Town:Label><Town:Label><Town:Text>y</Town:Text></Town:Label></Town:Labels>
<Town:Point><geom:coord><geom:c1>5.5</geom:c1><geom:c2>-3</geom:c2></geom:coord></Town:Point><Town:Height>61.2</Town:Height>
<Town:holder ili:ref="o24"/><Town:Place><Town:Address><Town:Street>Up</Town:Street></Town:Address></Town:Place>
<Town:Floors>19</Town:Floors></Town:House>
<Town:Owner ili:tid="o24"><Town:Name>Cy</Town:Name></Town:Owner>
<Town:Owns><Town:owner ili:ref="o24" ili:bid="far"/><Town:house ili:ref="h24"/><Town:Share>5</Town:Share></Town:Owns>
</Town:Plan>
<Town:Notes ili:bid="n24"><Town:Owner ili:tid="o24"><Town:Name>note</Town:Name></Town:Owner></Town:Notes>
</ili:datasection>
</ili:transfer>
"""
